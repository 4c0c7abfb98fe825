"""Layered storage: raw partitions, tables, versioned feature tables and the catalog."""

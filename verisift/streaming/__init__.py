"""Structured Streaming front for the stateless operators."""

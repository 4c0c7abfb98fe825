"""Relational operators: adapters, checks, rules, gate, features, monitoring, what-if."""

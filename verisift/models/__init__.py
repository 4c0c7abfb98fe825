"""Distributed training, scoring and evaluation."""

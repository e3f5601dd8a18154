"""Operators: loan status, customer history, metrics, accounting blocks, sinks."""

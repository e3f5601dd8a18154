"""Whole runs: status load, monthly metrics, accounting extract."""

"""Loan portfolio analytics on Spark: status history, monthly metrics, accounting extract."""

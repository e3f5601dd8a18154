"""Table readers, the calendar and the adapters for the sample tables."""

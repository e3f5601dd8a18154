"""The same results in plain SQL, written row by row for comparison with the Spark queries."""

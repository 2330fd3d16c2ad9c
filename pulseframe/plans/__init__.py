"""Models built from operators, and the query catalogue."""

"""Job-level plans and the query catalogue."""

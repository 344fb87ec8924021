"""Rule-driven stages, test-table adapters and the query catalogue."""

"""Table-to-table jobs."""

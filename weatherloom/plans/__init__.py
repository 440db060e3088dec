"""Complete runs, and the queries on the given tables."""

"""End-to-end jobs, the query registry and plan checks."""

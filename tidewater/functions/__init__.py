"""Column functions: time, text, maps and aggregates."""

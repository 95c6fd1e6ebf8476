"""Column functions and functions registered for SQL."""

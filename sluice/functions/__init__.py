"""Column functions and reusable patterns."""

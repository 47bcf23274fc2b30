"""Column expressions and the small building blocks the operators share."""

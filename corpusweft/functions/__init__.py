"""Column functions: no shuffles, and Python only where parsing has no relational form."""

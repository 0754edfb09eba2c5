"""Column functions: expressions in, expressions out."""

"""Column builders, exact distributed ranks and exact quantiles."""

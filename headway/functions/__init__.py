"""Column functions: missing values, rounding, recoding, aggregates, geometry."""

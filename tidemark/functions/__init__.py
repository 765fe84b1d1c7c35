"""Column expressions. Each takes and returns a Column; none is a UDF."""

"""Column expressions. Everything here is built-in Spark: no UDF, no action."""

"""Column expressions. Every function takes and returns Spark columns; none uses a Python UDF."""

"""Column functions over plain Spark columns."""

"""Commerce analytics as Spark DataFrame operators."""

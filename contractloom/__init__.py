"""Contract position analytics as Spark DataFrame operators."""

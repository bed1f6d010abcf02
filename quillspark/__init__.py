"""Review-text analytics as Spark DataFrame operators."""

"""Grant-funding analytics written as Spark DataFrame operators."""

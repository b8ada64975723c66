"""Customer-attrition analytics as Spark DataFrame operators."""

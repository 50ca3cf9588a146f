"""Event-registration analytics as Spark DataFrame operators."""

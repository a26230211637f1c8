"""Security-log analytics as plain Spark DataFrame transformations."""

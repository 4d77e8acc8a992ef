"""Banking customer-data lake operators and reports on the Spark DataFrame API."""

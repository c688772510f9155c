"""meterline: Spark-first DataFrame operators for meter, customer and text data."""

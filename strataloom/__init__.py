"""A Spark-first engine for analysing literature records."""

"""Job-posting analytics on Spark."""

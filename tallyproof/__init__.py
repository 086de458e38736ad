"""Daily audit of billing documents, written as Spark DataFrame jobs."""

"""Registration, grading and sales analytics expressed as Spark DataFrame jobs."""

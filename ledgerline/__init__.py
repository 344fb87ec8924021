"""Order-book and customer analytics as Spark DataFrame jobs."""

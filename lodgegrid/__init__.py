"""Short-term-rental listing and census analytics as Spark DataFrame jobs."""

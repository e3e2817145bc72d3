"""Subscription and audience analytics as Spark DataFrame jobs."""

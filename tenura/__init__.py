"""Subscription analytics as Spark DataFrame jobs."""

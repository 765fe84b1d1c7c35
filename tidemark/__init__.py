"""Engagement analytics on Spark: event stream to bronze, silver, gold and mart."""

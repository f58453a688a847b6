"""Surgical-robot fleet analytics on Spark: validation, star-schema loads, views, reports and streams."""

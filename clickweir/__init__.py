"""Clickstream and order analytics expressed as Spark DataFrame jobs."""

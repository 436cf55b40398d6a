"""Clickstream analytics expressed as Spark DataFrame plans."""

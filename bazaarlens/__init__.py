"""Marketplace sales analytics as Spark DataFrame plans."""

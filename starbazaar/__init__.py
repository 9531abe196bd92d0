"""Marketplace star-schema analytics on Spark."""

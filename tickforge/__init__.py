"""Snapshot market-data analytics as lazy PySpark DataFrame operators."""

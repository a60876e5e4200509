"""Retail customer analytics as PySpark DataFrame operators."""

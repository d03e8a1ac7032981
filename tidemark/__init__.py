"""Warehouse usage and space analytics as Spark DataFrame operators."""

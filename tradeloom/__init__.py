"""Retail, booking and document analytics as plain Spark DataFrame work."""

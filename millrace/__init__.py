"""Millrace: record cleaning, loading and analytics marts as plain Spark jobs."""

__version__ = "0.1.0"

"""Foliospark: corpus building and corpus analysis as Spark DataFrame jobs."""

__version__ = "0.1.0"

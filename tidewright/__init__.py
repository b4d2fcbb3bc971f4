"""Incremental ELT into a star schema, written as Spark DataFrame jobs."""

__version__ = "0.1.0"

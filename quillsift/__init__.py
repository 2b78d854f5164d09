"""Data-quality and incremental-load operators expressed as Spark DataFrame functions."""

__version__ = "0.1.0"

"""Spark-first analytics over ordered, time-stamped media metadata and text."""

__version__ = "0.1.0"

"""Imaging-study metadata and report analytics as Spark DataFrame functions."""

__version__ = "0.1.0"

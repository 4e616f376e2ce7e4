"""Lathework: data-processing operators as PySpark DataFrame functions."""

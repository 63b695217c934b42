"""A document-corpus processing engine for PySpark."""

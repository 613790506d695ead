"""Retail sales warehouse built as Spark DataFrame plans."""

"""The same results in SQL for DuckDB, written independently of the Spark plans."""

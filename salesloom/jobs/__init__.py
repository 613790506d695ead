"""Batch entry points, run with ``python -m salesloom.jobs.<name>`` or spark-submit."""

"""Operators of a training-data pipeline: detection, joins, indexes, scoring, packing."""

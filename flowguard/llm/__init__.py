"""Operators of a large-scale training-data pipeline (text tables in, decisions out)."""

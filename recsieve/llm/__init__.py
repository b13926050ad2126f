"""Operators of a training-data pipeline. Nothing else in recsieve imports this subpackage."""

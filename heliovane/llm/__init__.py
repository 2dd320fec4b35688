"""Operators of a training-data pipeline: text, vectors and pages at corpus scale."""

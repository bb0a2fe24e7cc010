"""Operators of a training-data pipeline (numbered 1-10); see the README."""

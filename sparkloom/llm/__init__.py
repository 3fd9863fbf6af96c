"""Operators for training-data pipelines (language ID, dedup, scoring, mixing...).

Nothing else in the library imports this subpackage.
"""

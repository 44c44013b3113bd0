"""Operators of a training-data pipeline: de-duplication, filtering, encoding, mixing.

Nothing else in the library imports this subpackage.
"""

"""Operators for large-scale training-data preparation.

Nothing else in the library imports this subpackage. ``queries`` holds the
registered queries and their SQL; each operator has a module of its own.
"""

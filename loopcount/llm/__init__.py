"""Operators for large text and vector collections (training-data preparation).

Nothing else in the library imports this subpackage. ``queries.py`` holds the registered
queries ``opN_<name>``; every other module holds one operator.
"""

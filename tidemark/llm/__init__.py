"""Operators of a training-data pipeline over tables of documents and pages.

Nothing else in the library imports this subpackage.
"""

"""Operators for preparing large text corpora (training data).

Nothing else in the library imports this subpackage. Each module holds one
operator with its own general interface; ``queries`` registers one thin query
per operator over the driver's tables.
"""

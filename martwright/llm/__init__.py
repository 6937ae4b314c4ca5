"""Operators for preparing training data from documents, pages, vectors and conversations.

Nothing else in the package imports this one. Each operator takes DataFrames and column names and
returns DataFrames; ``queries`` applies them to the test tables.
"""

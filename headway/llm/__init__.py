"""Operators that turn crawled text into training data.

Shared rules: a null text counts as empty; columns starting with ``__`` are reserved for the operators; a
column of the input that has the name of a result column is replaced by it.
"""

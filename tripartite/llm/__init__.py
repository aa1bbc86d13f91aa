"""Operators for preparing training text, each on DataFrames of documents.

Nothing outside this subpackage imports it. ``queries`` registers one query for each.
"""

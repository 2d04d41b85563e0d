"""Operators for preparing large text collections for model training.

Nothing outside this subpackage imports it; ``queries`` holds its registered queries and their SQL.
"""

"""Operators for preparing language-model training data, and their queries.

Nothing outside this package imports it; ``llm.queries`` registers the queries.
"""

"""Registered queries over the star-schema, event, text and vector tables."""

from tallywood.queries import (  # noqa: F401  (importing registers)
    evaluation,
    learning,
    pairs,
    recommending,
    relational,
    sources,
    statistics,
    streaming,
    texts,
)
from tallywood.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

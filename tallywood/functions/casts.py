"""Parsing and decoding of single values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_or(text: Column, kind: str, default: object) -> Column:
    """Value of ``text`` as ``kind``, or ``default`` where it does not parse."""
    return F.coalesce(text.try_cast(kind), F.lit(default).cast(kind))


def decode(code: Column, labels: dict, otherwise: str | None = None) -> Column:
    """Label of a code; null codes stay null."""
    out = None
    for value, label in labels.items():
        out = (F if out is None else out).when(code == value, label)
    return out.when(code.isNotNull(), otherwise)


def suffixed(value: Column, suffix: str) -> Column:
    """Value as text with a suffix."""
    return F.concat(value.cast("string"), F.lit(suffix))

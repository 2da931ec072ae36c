"""Maps, arrays and structs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_of_all_kinds(
    pairs: Sequence[tuple[Column, Column]],
    items: Sequence[Column],
    text: Column,
    fields: dict[str, Column],
) -> list[Column]:
    """A map, an array, a string and a struct as columns ``m``, ``a``, ``s``, ``r``."""
    return [
        F.create_map(*[part for pair in pairs for part in pair]).alias("m"),
        F.array(*items).alias("a"),
        text.cast("string").alias("s"),
        F.struct(*[value.alias(name) for name, value in fields.items()]).alias("r"),
    ]


def one_hot_index(columns: Sequence[str]) -> Column:
    """Position of the column that is set, or -1 where none is."""
    flags = F.array(*[F.col(c).cast("double") for c in columns])
    return (F.array_position(flags, F.lit(1.0)) - 1).cast("double")

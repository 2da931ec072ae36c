"""Arithmetic on number arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two arrays, added up in double precision."""

    def gap(x: Column, y: Column) -> Column:
        d = x.cast("double") - y.cast("double")
        return d * d

    return F.aggregate(F.zip_with(a, b, gap), F.lit(0.0), lambda total, g: total + g)

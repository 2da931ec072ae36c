"""Delimited text in and out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv_all_strings(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header line; every column is a string."""
    return spark.read.option("header", True).csv(path)


def read_csv_positional(
    spark: SparkSession,
    path: str,
    names: Sequence[str],
    schema: StructType | str | None = None,
    sampling_ratio: float = 1.0,
) -> DataFrame:
    """Headerless CSV whose columns are named by position.

    Types are inferred, which reads the input once more; give ``schema`` to
    read it only once, or a smaller ``sampling_ratio`` where a sample of the
    lines is known to show the types.
    """
    reader = spark.read.option("header", False)
    if schema is not None:
        return reader.schema(schema).csv(path).toDF(*names)
    inferring = reader.option("inferSchema", True).option("samplingRatio", sampling_ratio)
    return inferring.csv(path).toDF(*names)


def read_csv_declared(
    spark: SparkSession, path: str, schema: StructType | str, header: bool = False
) -> DataFrame:
    """CSV read under a declared schema, without inference."""
    return spark.read.option("header", header).schema(schema).csv(path)


def read_text_fields(
    spark: SparkSession, path: str, fields: Mapping[str, str], delimiter: str = " "
) -> DataFrame:
    """Text lines cut at ``delimiter`` into typed fields ``{name: type}``.

    A line with too few fields, or with one that does not parse, gives nulls
    in those fields; see ``parse_or_drop`` for dropping such lines.
    """
    parts = F.split("value", f"\\Q{delimiter}\\E")
    return spark.read.text(path).select(
        *[
            F.trim(F.get(parts, F.lit(i))).try_cast(kind).alias(name)
            for i, (name, kind) in enumerate(fields.items())
        ]
    )


def write_result_csv(
    df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False
) -> None:
    """Result as CSV with a header.

    ``single_file`` funnels the result through one task; it is for small
    results that a person downloads and is off by default. ``mode`` may be
    ``error`` to refuse an existing path.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)

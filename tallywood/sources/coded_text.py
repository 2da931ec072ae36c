"""Delimited text with a coded gender column.

Spark reads and splits the lines in the JVM, cuts large files into splits, and
prunes and filters with Catalyst.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructType

# Fixed values of the format: its default columns, the coded column, the code
# that stands for the first label, and the two labels.
CODED_TEXT_SCHEMA = "id string, name string, gender string, salary bigint, expenses bigint"
CODED_COLUMN = "gender"
FIRST_CODE = 1
FIRST_LABEL = "Male"
OTHER_LABEL = "Female"
READ_DELIMITER = ","
WRITE_DELIMITER = "|"

# Characters trimmed from both ends of a field.
BLANKS = " \t\n\r\x0b\x0c"


def _schema(schema: StructType | str | None) -> StructType:
    if isinstance(schema, StructType):
        chosen = schema
    else:
        chosen = StructType.fromDDL(schema or CODED_TEXT_SCHEMA)
    for field in chosen.fields:
        if not isinstance(field.dataType, (IntegerType, LongType, StringType)):
            raise ValueError(f"coded text has int, bigint and string columns, not {field}")
    return chosen


def decode_gender(code: Column) -> Column:
    """Label of a code: one code has the first label, any other the second."""
    return F.when(code.cast("int") == FIRST_CODE, FIRST_LABEL).when(
        code.isNotNull(), OTHER_LABEL
    )


def read_coded_text(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    delimiter: str = READ_DELIMITER,
) -> DataFrame:
    """Scan delimited text: trimmed fields, decoded gender, empty fields null."""
    parts = F.split("value", f"\\Q{delimiter}\\E", -1)
    columns = []
    for i, field in enumerate(_schema(schema).fields):
        text = F.btrim(F.get(parts, F.lit(i)), F.lit(BLANKS))
        text = F.when(text != "", text)
        coded = field.name.lower() == CODED_COLUMN
        value = decode_gender(text) if coded else text
        columns.append(value.cast(field.dataType).alias(field.name))
    lines = spark.read.text(path).where(F.btrim("value", F.lit(BLANKS)) != "")
    return lines.select(*columns)


def write_coded_text(
    df: DataFrame,
    path: str,
    mode: str = "error",
    layout: str = "customFormat",
    delimiter: str = WRITE_DELIMITER,
) -> None:
    """Write delimiter-joined text lines, or JSON lines with ``layout="json"``.

    A null becomes an empty field. A value that holds the delimiter or a line
    break would read back as something else, so it stops the write.
    """
    if layout == "json":
        df.write.mode(mode).json(path)
        return
    if layout != "customFormat":
        raise ValueError(f"unknown layout {layout!r}")

    def field(name: str) -> Column:
        text = F.coalesce(F.col(name).cast("string"), F.lit(""))
        breaks = text.contains(delimiter) | text.contains("\n") | text.contains("\r")
        message = F.concat(F.lit(f"column {name} holds a delimiter or line break: "), text)
        return F.when(breaks, F.raise_error(message).cast("string")).otherwise(text)

    line = F.concat_ws(delimiter, *[field(c) for c in df.columns])
    df.select(line.alias("value")).write.mode(mode).text(path)

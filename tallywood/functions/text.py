"""Text expressions. All of them run in the JVM on the whole text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


WHITE_SPACE = r"\s+"


def words(text: Column) -> Column:
    """Words of a text, cut at white space, without empty ones."""
    return F.filter(F.split(text, WHITE_SPACE), lambda word: word != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def extract_whole(text: Column, pattern: str) -> Column:
    """First match of a pattern, or the empty string."""
    return F.regexp_extract(text, pattern, 0)


def extract_group(text: Column, pattern: str, group: int = 1) -> Column:
    """Group of the first match of a pattern, or the empty string."""
    return F.regexp_extract(text, pattern, group)


def suffix_after(text: Column, marker: str, skip: int = 1) -> Column:
    """Text after the last ``marker`` less ``skip`` separator characters.

    Null where the marker does not occur.
    """
    tail = F.substring_index(text, marker, -1)
    return F.when(text.contains(marker), F.substr(tail, F.lit(skip + 1)))


def delete_all(text: Column, part: str) -> Column:
    return F.replace(text, F.lit(part), F.lit(""))


def replace_first(text: Column, part: str, by: str) -> Column:
    at = F.locate(part, text)
    replaced = F.overlay(text, F.lit(by), at, F.lit(len(part)))
    return F.when(at > 0, replaced).otherwise(text)


def replace_all(text: Column, part: str, by: str) -> Column:
    return F.replace(text, F.lit(part), F.lit(by))

from tallywood.functions.casts import decode, parse_or, suffixed
from tallywood.functions.nested import one_hot_index, row_of_all_kinds
from tallywood.functions.text import (
    delete_all,
    extract_group,
    extract_whole,
    replace_all,
    replace_first,
    suffix_after,
    word_count,
    words,
)
from tallywood.functions.vectors import squared_distance

__all__ = [
    "decode",
    "delete_all",
    "extract_group",
    "extract_whole",
    "one_hot_index",
    "parse_or",
    "replace_all",
    "replace_first",
    "row_of_all_kinds",
    "squared_distance",
    "suffix_after",
    "suffixed",
    "word_count",
    "words",
]

from tallywood.sources.coded_text import (
    CODED_TEXT_SCHEMA,
    read_coded_text,
    write_coded_text,
)
from tallywood.sources.delimited import (
    read_csv_all_strings,
    read_csv_declared,
    read_csv_positional,
    read_text_fields,
    write_result_csv,
)
from tallywood.sources.tables import keyed_read, keyed_write, overwrite_buckets, overwrite_table, publish

__all__ = [
    "CODED_TEXT_SCHEMA",
    "keyed_read",
    "keyed_write",
    "overwrite_buckets",
    "overwrite_table",
    "publish",
    "read_coded_text",
    "read_csv_all_strings",
    "read_csv_declared",
    "read_csv_positional",
    "read_text_fields",
    "write_coded_text",
    "write_result_csv",
]

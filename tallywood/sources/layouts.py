"""Readers for the record layouts that the ready-made jobs work on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywood.learning.features import CATEGORY_PREFIX
from tallywood.sources.delimited import (
    read_csv_all_strings,
    read_csv_declared,
    read_csv_positional,
    read_text_fields,
)

# Column names and types of the files.
CHURN_ACCOUNTS = """
    state_code string, account_length int, area_code string,
    international_plan string, voice_mail_plan string, num_voice_mail double,
    total_day_mins double, total_day_calls double, total_day_charge double,
    total_evening_mins double, total_evening_calls double, total_evening_charge double,
    total_night_mins double, total_night_calls double, total_night_charge double,
    total_international_mins double, total_international_calls double,
    total_international_charge double, total_international_num_calls double, churn string
"""
COVER_NUMBERS = [
    "Elevation", "Aspect", "Slope", "Horizontal_Distance_To_Hydrology",
    "Vertical_Distance_To_Hydrology", "Horizontal_Distance_To_Roadways", "Hillshade_9am",
    "Hillshade_Noon", "Hillshade_3pm", "Horizontal_Distance_To_Fire_Points",
]
COVER_WILDERNESS = [f"Wilderness_Area_{i}" for i in range(4)]
COVER_SOIL = [f"Soil_Type_{i}" for i in range(40)]
COVER_LABEL = "Cover_Type"
NETWORK_CATEGORIES = ["protocol_type", "service", "flag"]
NETWORK_LABEL = "label"
NETWORK_COLUMNS = [
    "duration", "protocol_type", "service", "flag", "src_bytes", "dst_bytes", "land",
    "wrong_fragment", "urgent", "hot", "num_failed_logins", "logged_in", "num_compromised",
    "root_shell", "su_attempted", "num_root", "num_file_creations", "num_shells",
    "num_access_files", "num_outbound_cmds", "is_host_login", "is_guest_login", "count",
    "srv_count", "serror_rate", "srv_serror_rate", "rerror_rate", "srv_rerror_rate",
    "same_srv_rate", "diff_srv_rate", "srv_diff_host_rate", "dst_host_count",
    "dst_host_srv_count", "dst_host_same_srv_rate", "dst_host_diff_srv_rate",
    "dst_host_same_src_port_rate", "dst_host_srv_diff_host_rate", "dst_host_serror_rate",
    "dst_host_srv_serror_rate", "dst_host_rerror_rate", "dst_host_srv_rerror_rate", "label",
]


def read_churn_accounts(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    return read_csv_declared(spark, path, CHURN_ACCOUNTS, header)


def read_claims(spark: SparkSession, path: str) -> DataFrame:
    """Claims with a header: categorical columns stay text, all others become numbers."""
    raw = read_csv_all_strings(spark, path)
    return raw.select(
        *[
            F.col(c) if c.startswith(CATEGORY_PREFIX) else F.col(c).cast("double").alias(c)
            for c in raw.columns
        ]
    )


def read_cover(spark: SparkSession, path: str) -> DataFrame:
    """Land cover records: numbers, two groups of 0/1 columns, and the class."""
    names = [*COVER_NUMBERS, *COVER_WILDERNESS, *COVER_SOIL, COVER_LABEL]
    schema = ", ".join(f"{n} {'double' if n == COVER_LABEL else 'int'}" for n in names)
    return read_csv_positional(spark, path, names, schema)


def read_network(spark: SparkSession, path: str) -> DataFrame:
    """Network connection records."""
    text = {*NETWORK_CATEGORIES, NETWORK_LABEL}
    schema = ", ".join(f"`{n}` {'string' if n in text else 'double'}" for n in NETWORK_COLUMNS)
    return read_csv_positional(spark, path, NETWORK_COLUMNS, schema)


def read_plays(spark: SparkSession, path: str) -> DataFrame:
    """Space-delimited ``user item count`` lines; unreadable lines are dropped."""
    fields = {"user": "bigint", "item": "bigint", "plays": "bigint"}
    return read_text_fields(spark, path, fields, " ").dropna()


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Tab-delimited ``id name`` lines; lines without a number are dropped."""
    fields = {"item": "bigint", "name": "string"}
    return read_text_fields(spark, path, fields, "\t").where("item is not null")


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    """Tab-delimited ``item alias`` lines, one row per item; empty ones are skipped."""
    fields = {"item": "bigint", "alias": "bigint"}
    found = read_text_fields(spark, path, fields, "\t").dropna()
    return found.groupBy("item").agg(F.max("alias").alias("alias"))

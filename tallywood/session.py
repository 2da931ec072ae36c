"""Session defaults."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC keeps timestamps comparable across engines. The adaptive settings are
# Spark's defaults, spelled out because the operators count on them: a join
# side is broadcast only when its measured size is under the threshold, and a
# skewed partition of a shuffled join is split.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    app_name: str, master: str | None = None, hive: bool = False, **conf: str
) -> SparkSession:
    """Session with the library's defaults; ``conf`` keys use ``__`` for dots.

    ``hive`` keeps the table catalog in a Hive metastore, where Spark has that.
    """
    builder = SparkSession.builder.appName(app_name)
    if hive:
        builder = builder.enableHiveSupport()
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()

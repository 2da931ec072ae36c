"""Hot-key handling gives what one window or one join would give."""

from __future__ import annotations

import random
from types import SimpleNamespace

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallywood import plans
from tallywood.operators import joins, windows
from tallywood.plans.ordered import ordered_runs
from tallywood.plans import find_heavy


def rows_of(frame):
    return sorted([tuple(r) for r in frame.collect()], key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 0 holds a third of the rows, the null key a tenth; values have gaps."""
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        draw = rng.random()
        key = 0 if draw < 0.34 else None if draw < 0.44 else rng.randrange(1, 200)
        value = None if rng.random() < 0.4 else rng.randrange(100)
        rows.append((key, i * 7919 % 3001, value))
    return spark.createDataFrame(rows, "k int, at int, v int").repartition(6).cache()


def test_heavy_keys_are_the_large_ones(skewed):
    heavy = find_heavy(skewed, ["k"], 200)
    found = {r["k"]: r["_n"] for r in heavy.frame.collect()}
    counts = {r["k"]: r["count"] for r in skewed.groupBy("k").count().collect()}
    assert found == {k: n for k, n in counts.items() if n >= 200}
    assert set(found) == {0, None}
    assert heavy.rows == sum(found.values())
    assert find_heavy(skewed, ["k"], 10**6) is None


def test_heavy_keys_of_a_larger_table_are_found_by_sample(spark):
    key = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 50_000)
    frame = spark.range(600_000).select(key.alias("k"))
    heavy = find_heavy(frame, ["k"], 50_000)
    (only,) = heavy.frame.collect()
    assert only["k"] == -1 and 180_000 < only["_n"] < 260_000


def test_heavy_groups_are_cut_into_runs(skewed):
    runs, cut = ordered_runs(skewed, ["k"], ["at"], find_heavy(skewed, ["k"], 200))
    assert cut
    per_key = {
        r["k"]: r["runs"]
        for r in runs.where("_run >= 0").groupBy("k").agg(F.countDistinct("_run").alias("runs")).collect()
    }
    assert per_key[0] > 1
    assert runs.count() == skewed.count()


@pytest.mark.parametrize("min_rows", [10**6, 200, 40])
def test_running_sums(skewed, min_rows):
    expected = skewed.withColumn(
        "s",
        F.sum("v").over(
            Window.partitionBy("k").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
        ),
    )
    got = plans.running_sums(skewed, ["at"], {"s": "v"}, ["k"], min_rows=min_rows)
    assert rows_of(got) == rows_of(expected)


def test_running_sums_without_key_descending(skewed):
    expected, total = [], 0
    for r in sorted(skewed.collect(), key=lambda r: -r["at"]):
        total += r["v"] or 0
        expected.append((r["at"], total))
    got = plans.running_sums(
        skewed.fillna(0, ["v"]), [F.desc("at")], {"s": "v"}
    ).select("at", "s")
    assert rows_of(got) == sorted(expected, key=repr)


@pytest.mark.parametrize("min_rows", [10**6, 200, 40])
def test_first_last_and_fill(skewed, min_rows):
    w = Window.partitionBy("k").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    expected = skewed.select(
        "*",
        F.first("v", True).over(w).alias("first_val"),
        F.last("v", True).over(w).alias("last_val"),
    )
    got = windows.first_last_non_null(skewed, ["k"], ["at"], "v", min_rows=min_rows)
    assert rows_of(got) == rows_of(expected)
    filled = windows.forward_fill(skewed, ["k"], ["at"], "v", min_rows=min_rows)
    assert rows_of(filled) == rows_of(
        expected.select("k", "at", F.coalesce("v", "last_val").alias("v"))
    )


@pytest.mark.parametrize("min_rows", [10**6, 200])
def test_number_within(skewed, min_rows):
    expected = skewed.withColumn(
        "n", F.row_number().over(Window.partitionBy("k").orderBy("at")).cast("long") - 1
    )
    got = plans.number_within(skewed, ["k"], ["at"], "n", min_rows=min_rows)
    assert rows_of(got) == rows_of(expected)


def test_number_rows_is_consecutive(spark):
    frame = spark.range(0, 5000, 1, 7).select(F.pmod(F.col("id") * 7919, F.lit(5003)).alias("x"))
    got = plans.number_rows(frame, ["x"]).collect()
    assert [r["idx"] for r in sorted(got, key=lambda r: r["x"])] == list(range(5000))


def test_equal_rows_of_a_hot_key_reach_several_tasks(spark):
    hot = spark.range(0, 400_000, 1, 8).select((F.lit(7) + 0 * F.col("id")).alias("k"), F.lit("x" * 20).alias("v"))
    lookup = spark.range(200_000).select(F.col("id").alias("k"), F.lit("name" * 10).alias("name"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = joins.keep_known(hot, lookup, "k").withColumn("task", F.spark_partition_id())
        tasks = joined.groupBy("task").count().where("count > 0").count()
        assert joined.count() == 400_000 and tasks > 1
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_scratch_paths_lie_in_the_shared_folder(spark):
    first, second = plans.scratch_path(spark, "x"), plans.scratch_path(spark, "x")
    assert first != second
    assert first.startswith(plans.checkpoint_root(spark))


def session_stub(configured, master, current=None):
    made = []
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: current, setCheckpointDir=made.append
    )
    conf = SimpleNamespace(get=lambda key, default: configured or default)
    return SimpleNamespace(sparkContext=context, conf=conf), made


def test_configured_checkpoint_folder_wins():
    stub, made = session_stub("hdfs://shared/x/", "yarn")
    assert plans.checkpoint_root(stub) == "hdfs://shared/x"
    assert made == ["hdfs://shared/x/"]


def test_cluster_without_checkpoint_folder_is_refused():
    stub, made = session_stub(None, "yarn")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        plans.checkpoint_root(stub)
    assert made == []

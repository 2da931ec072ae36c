"""Readers, writers and keyed tables, each run over a written copy of a table."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywood import sources
from tallywood.operators.groups import first_purchases
from tallywood.operators.rows import project
from tallywood.plans import materialized, scratch_path
from tallywood.queries.registry import Tables, query


def _line(separator: str, *fields: Column) -> Column:
    """Fields as one line; a null is an empty field, so the others keep their places."""
    return F.concat_ws(separator, *[F.coalesce(f.cast("string"), F.lit("")) for f in fields])


@query("csv_header_roundtrip", "SELECT * FROM customer")
def csv_header_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "customer-csv")
    sources.write_result_csv(t.customer, path)
    back = sources.read_csv_all_strings(t.spark, path)
    casts = {"c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double"}
    return project(back, {c: c for c in back.columns}, casts)


@query(
    "csv_infer_positional",
    "SELECT o_orderkey AS id, o_custkey AS buyer, o_orderstatus AS state, o_totalprice AS price "
    "FROM orders",
)
def csv_infer_positional(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "orders-csv")
    columns = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    columns.write.csv(path)
    back = sources.read_csv_positional(t.spark, path, ["id", "buyer", "state", "price"])
    return project(back, {c: c for c in back.columns}, {"id": "bigint", "buyer": "bigint"})


@query(
    "csv_declared_schema",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem",
)
def csv_declared_schema(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "lines-csv")
    columns = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    columns.write.csv(path)
    return sources.read_csv_declared(t.spark, path, columns.schema)


@query(
    "text_lines_parse",
    """SELECT CAST(l_orderkey AS BIGINT) AS user_id, CAST(l_partkey AS BIGINT) AS item_id,
              CAST(l_quantity AS BIGINT) AS plays
       FROM lineitem""",
)
def text_lines_parse(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "plays-text")
    line = _line(" ", F.col("l_orderkey"), F.col("l_partkey"), F.col("l_quantity").cast("bigint"))
    t.lineitem.select(line).write.text(path)
    fields = {"user_id": "bigint", "item_id": "bigint", "plays": "bigint"}
    return sources.read_text_fields(t.spark, path, fields)


CODED_SQL = """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
                      CASE WHEN c_nationkey % 3 = 1 THEN 'Male' ELSE 'Female' END AS gender,
                      CAST(floor(c_acctbal) AS BIGINT) AS salary,
                      CAST(c_nationkey * 100 AS BIGINT) AS expenses
               FROM customer"""


def coded_customers(t: Tables) -> str:
    """Customers as lines with blanks around the fields and a gender code."""
    path = scratch_path(t.spark, "coded-text")
    line = _line(
        " , ",
        F.col("c_custkey"),
        F.col("c_name"),
        F.col("c_nationkey") % 3,
        F.floor("c_acctbal"),
        F.col("c_nationkey") * 100,
    )
    t.customer.select(line).write.text(path)
    return path


@query("text_source_scan", CODED_SQL)
def text_source_scan(t: Tables) -> DataFrame:
    return sources.read_coded_text(t.spark, coded_customers(t))


@query("text_source_pruned", f"SELECT name, id FROM ({CODED_SQL})")
def text_source_pruned(t: Tables) -> DataFrame:
    return sources.read_coded_text(t.spark, coded_customers(t)).select("name", "id")


@query(
    "text_source_filtered",
    f"SELECT id, salary FROM ({CODED_SQL}) WHERE gender = 'Male' AND salary > 5000",
)
def text_source_filtered(t: Tables) -> DataFrame:
    scan = sources.read_coded_text(t.spark, coded_customers(t))
    return scan.where("gender = 'Male' and salary > 5000").select("id", "salary")


ORDER_TEXT_SQL = """SELECT CAST(o_orderkey AS BIGINT) AS id,
                           CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS state,
                           o_orderpriority AS priority FROM orders"""


def _order_text(t: Tables) -> DataFrame:
    state = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        state.alias("state"),
        F.col("o_orderpriority").alias("priority"),
    )


@query("pipe_text_sink_roundtrip", ORDER_TEXT_SQL)
def pipe_text_sink_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "pipe-text")
    frame = _order_text(t)
    sources.write_coded_text(frame, path)
    return sources.read_coded_text(t.spark, path, frame.schema, sources.coded_text.WRITE_DELIMITER)


@query("json_sink_roundtrip", ORDER_TEXT_SQL)
def json_sink_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "json")
    frame = _order_text(t)
    sources.write_coded_text(frame, path, layout="json")
    return t.spark.read.schema(frame.schema).json(path)


@query(
    "submission_csv_writer",
    "SELECT CAST(l_orderkey AS BIGINT) AS id, l_extendedprice AS loss FROM lineitem",
)
def submission_csv_writer(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "submission")
    result = project(
        t.lineitem, {"id": "l_orderkey", "loss": "l_extendedprice"}, {"id": "bigint"}
    )
    sources.write_result_csv(result, path)
    return sources.read_csv_declared(t.spark, path, result.schema, header=True)


@query(
    "keyed_upsert_latest",
    """WITH r AS (SELECT event_id, user_id, event_type, value,
                         row_number() OVER (PARTITION BY user_id
                                            ORDER BY CASE WHEN coalesce(value < 5, false) THEN 1 ELSE 0 END,
                                                     ts DESC, event_id DESC) AS k
                  FROM events)
       SELECT event_id, user_id, event_type, value FROM r WHERE k = 1""",
)
def keyed_upsert_latest(t: Tables) -> DataFrame:
    """Small events first, the others after: they win over any small one."""
    path = scratch_path(t.spark, "keyed")
    is_small = F.coalesce(F.col("value") < 5, F.lit(False))
    small, others = t.events.where(is_small), t.events.where(~is_small)
    for frame in (small, others):
        sources.keyed_write(frame, path, key="user_id", order_by=["ts", "event_id"])
    stored = sources.keyed_read(t.spark, path)
    return stored.select("event_id", "user_id", "event_type", "value")


@query("keyed_uuid_write", "SELECT * FROM customer")
def keyed_uuid_write(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "uuid-keyed")
    sources.keyed_write(t.customer, path)
    return sources.keyed_read(t.spark, path)


@query(
    "first_purchase_table",
    """SELECT o_custkey AS user_id, min(o_orderkey) AS order_id,
              CAST(min(o_orderdate) AS VARCHAR) AS order_time,
              CAST(min(paid) AS VARCHAR) AS pay_time, 'orders' AS origin
       FROM orders JOIN (SELECT l_orderkey, min(l_shipdate) AS paid FROM lineitem
                         GROUP BY l_orderkey) ON o_orderkey = l_orderkey
       WHERE o_orderstatus <> 'P' GROUP BY o_custkey""",
)
def first_purchase_table(t: Tables) -> DataFrame:
    paid = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_shipdate").alias("paid")
    )
    orders = t.orders.join(paid, "o_orderkey")
    found = first_purchases(
        orders.withColumnRenamed("o_custkey", "user_id"),
        "user_id",
        {"order_id": "o_orderkey", "order_time": "o_orderdate", "pay_time": "paid"},
        F.col("o_orderstatus") != "P",
        origin="orders",
    )
    # Inserted in two halves over the buckets of rows marked ``before``: each insert replaces
    # its own buckets only. A name of its own, so that runs at once do not meet.
    path = scratch_path(t.spark, "first-purchase")
    name = f"first_purchase_{uuid.uuid4().hex}"
    found = materialized(found, "first-purchases")
    sources.overwrite_buckets(found.withColumn("origin", F.lit("before")), path, name, "user_id")
    low = F.col("bucket") < sources.tables.BUCKETS // 2
    buckets = t.spark.table(name).select("user_id", "bucket").distinct()
    for half in (low, ~low):
        part = materialized(found.join(buckets.where(half), "user_id", "left_semi"), "half")
        sources.overwrite_buckets(part, path, name, "user_id")
    stored = t.spark.read.parquet(path).drop("bucket")
    t.spark.sql(f"DROP TABLE {name}")  # the catalog entry; the files stay
    return project(
        stored, {c: c for c in stored.columns}, {"order_time": "string", "pay_time": "string"}
    )

"""Key-value operators over words, lines and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.operators import pairs
from tallywood.plans import number_rows
from tallywood.queries.registry import Tables, query


def words_sql(table: str) -> str:
    return f"""SELECT word, count(*) AS n
               FROM (SELECT unnest(regexp_split_to_array(text, '\\s+')) AS word FROM {table})
               WHERE word <> '' GROUP BY word"""


@query("word_count", words_sql("documents"))
def word_count(t: Tables) -> DataFrame:
    return pairs.count_words(t.documents, "text")


@query(
    "repartition_then_sum",
    """SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
       FROM lineitem GROUP BY l_suppkey""",
)
def repartition_then_sum(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_suppkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    sums = pairs.partitioned_sum(lines, "l_suppkey", "price", 2)
    return sums.withColumn("total", F.col("total").cast("double"))


@query(
    "fold_by_key",
    """SELECT l_suppkey, CAST(sum(l_linenumber) + 2 AS BIGINT) AS total
       FROM lineitem GROUP BY l_suppkey""",
)
def fold_by_key(t: Tables) -> DataFrame:
    return pairs.fold_by_key(t.lineitem, "l_suppkey", "l_linenumber", 2)


def frequency_sql(table: str, side: str) -> str:
    return f"""SELECT n, '{side}' AS side, word,
                      row_number() OVER (PARTITION BY n ORDER BY word) - 1 AS position
               FROM ({words_sql(table)})"""


@query(
    "words_by_frequency_join",
    f"""WITH a AS ({frequency_sql("documents", "left")}),
             b AS ({frequency_sql("conversations", "right")})
        SELECT n, side, position, word FROM a WHERE n IN (SELECT n FROM b)
        UNION ALL SELECT n, side, position, word FROM b WHERE n IN (SELECT n FROM a)""",
)
def words_by_frequency_join(t: Tables) -> DataFrame:
    left = pairs.words_by_frequency(pairs.count_words(t.documents, "text"))
    right = pairs.words_by_frequency(pairs.count_words(t.conversations, "text"))
    return pairs.shared_frequencies(left, right)


@query(
    "row_index_sorted",
    """SELECT o_orderkey, o_totalprice,
              row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS idx
       FROM orders""",
)
def row_index_sorted(t: Tables) -> DataFrame:
    return number_rows(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"])


@query("unique_row_id")
def unique_row_id(t: Tables) -> DataFrame:
    return pairs.with_unique_id(t.orders.select("o_orderkey"))


@query(
    "unique_row_id_count",
    "SELECT count(*) AS n_rows, count(*) AS n_ids FROM orders",
)
def unique_row_id_count(t: Tables) -> DataFrame:
    ids = unique_row_id(t).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return ids.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_ids"))


@query(
    "avg_by_combiner",
    """SELECT l_partkey, CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS total,
              count(l_quantity) AS n,
              CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) / count(l_quantity)
                AS average
       FROM lineitem GROUP BY l_partkey""",
)
def avg_by_combiner(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_partkey", F.col("l_quantity").cast("decimal(18,2)").alias("quantity"))
    found = pairs.average_by_key(lines, "l_partkey", "quantity")
    total = F.col("total").cast("double")
    return found.select("l_partkey", total.alias("total"), "n", (total / F.col("n")).alias("average"))


@query(
    "concat_by_key",
    """SELECT l_suppkey, CAST(sum(n) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey) - n AS BIGINT)
                AS position, l_orderkey, n
       FROM (SELECT l_suppkey, l_orderkey, count(*) AS n FROM lineitem GROUP BY ALL)""",
)
def concat_by_key(t: Tables) -> DataFrame:
    return pairs.ordered_values(t.lineitem, "l_suppkey", "l_orderkey")


@query(
    "concat_by_key_text",
    """SELECT l_suppkey, part, string_agg(CAST(l_orderkey AS VARCHAR), '@' ORDER BY l_orderkey) AS joined
       FROM (SELECT l_suppkey, l_orderkey,
                    CAST((row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey) - 1) // 1000
                         AS BIGINT) AS part
             FROM lineitem)
       GROUP BY l_suppkey, part""",
)
def concat_by_key_text(t: Tables) -> DataFrame:
    """The orders of a supplier as text, a thousand to a row."""
    values = pairs.ordered_values(t.lineitem, "l_suppkey", "l_orderkey")
    return pairs.joined_text(values, "l_suppkey", "l_orderkey", "@", size=1000)


@query("map_values_suffix", "SELECT o_orderkey, o_orderstatus || '_' AS o_orderstatus FROM orders")
def map_values_suffix(t: Tables) -> DataFrame:
    return pairs.map_values(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus")


@query(
    "range_step",
    """SELECT k AS id, o_totalprice
       FROM (SELECT unnest(generate_series((SELECT min(o_orderkey) FROM orders),
                                           (SELECT max(o_orderkey) FROM orders), 2)) AS k)
       LEFT JOIN orders ON k = o_orderkey""",
)
def range_step(t: Tables) -> DataFrame:
    """Every second order number of the range in use, with its order if there is one."""
    bounds = t.orders.agg(F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi")).head()
    ids = t.spark.range(bounds["lo"], bounds["hi"] + 1, 2)
    orders = t.orders.select(F.col("o_orderkey").alias("id"), "o_totalprice")
    return ids.join(orders, "id", "left")

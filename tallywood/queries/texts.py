"""Text, nested and vector expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood import functions as fn
from tallywood.queries.registry import Tables, query


@query(
    "regex_extract_whole",
    """SELECT p_partkey, regexp_extract(p_brand, 'Brand#1(\\d+)', 0) AS found FROM part""",
)
def regex_extract_whole(t: Tables) -> DataFrame:
    found = fn.extract_whole(F.col("p_brand"), r"Brand#1(\d+)")
    return t.part.select("p_partkey", found.alias("found"))


@query(
    "url_param_extract",
    """SELECT page_id, regexp_extract(url, 'page=(\\d+)', 1) AS page FROM pages""",
)
def url_param_extract(t: Tables) -> DataFrame:
    return t.pages.select("page_id", fn.extract_group(F.col("url"), r"page=(\d+)").alias("page"))


@query(
    "suffix_after_marker",
    """SELECT page_id,
              CASE WHEN contains(url, 'page')
                   THEN substr(list_extract(string_split(url, 'page'), -1), 2) END AS suffix
       FROM pages""",
)
def suffix_after_marker(t: Tables) -> DataFrame:
    return t.pages.select("page_id", fn.suffix_after(F.col("url"), "page").alias("suffix"))


@query(
    "text_replace_ops",
    """SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars,
              CAST(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))
                   AS BIGINT) AS n_words,
              replace(text, 'the', '') AS deleted,
              regexp_replace(text, 'the', 'THE') AS first_replaced,
              replace(text, 'the', 'THE') AS all_replaced
       FROM documents""",
)
def text_replace_ops(t: Tables) -> DataFrame:
    text = F.col("text")
    return t.documents.select(
        "doc_id",
        F.length(text).cast("bigint").alias("n_chars"),
        fn.word_count(text).cast("bigint").alias("n_words"),
        fn.delete_all(text, "the").alias("deleted"),
        fn.replace_first(text, "the", "THE").alias("first_replaced"),
        fn.replace_all(text, "the", "THE").alias("all_replaced"),
    )


@query(
    "code_decode",
    """SELECT l_orderkey, l_linenumber,
              CASE WHEN l_linenumber = 1 THEN 'Male' ELSE 'Female' END AS gender,
              CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'R' THEN 'returned'
                   ELSE 'other' END AS flag,
              CAST(l_quantity AS INTEGER) AS quantity
       FROM lineitem""",
)
def code_decode(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        fn.decode(F.col("l_linenumber"), {1: "Male"}, "Female").alias("gender"),
        fn.decode(F.col("l_returnflag"), {"A": "accepted", "R": "returned"}, "other").alias("flag"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )


@query(
    "nested_row_access",
    """SELECT o_orderkey, o_custkey AS from_map, o_orderkey AS from_array, 2 AS n_items,
              o_orderstatus AS text, o_totalprice AS num, o_orderpriority AS str
       FROM orders""",
)
def nested_row_access(t: Tables) -> DataFrame:
    nested = t.orders.select(
        "o_orderkey",
        *fn.row_of_all_kinds(
            [(F.lit("customer"), F.col("o_custkey"))],
            [F.col("o_orderkey"), F.col("o_custkey")],
            F.col("o_orderstatus"),
            {"num": F.col("o_totalprice"), "str": F.col("o_orderpriority")},
        ),
    )
    return nested.select(
        "o_orderkey",
        F.col("m")["customer"].alias("from_map"),
        F.col("a")[0].alias("from_array"),
        F.size("a").alias("n_items"),
        F.col("s").alias("text"),
        F.col("r.num").alias("num"),
        F.col("r.str").alias("str"),
    )


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "one_hot_decode",
    """SELECT o_orderkey,
              CASE WHEN o_orderpriority = '5-LOW' THEN -1.0
                   ELSE CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) - 1 END AS category
       FROM orders""",
)
def one_hot_decode(t: Tables) -> DataFrame:
    """The last priority has no column of its own, so its rows have none set."""
    names = [f"priority_{i}" for i in range(len(PRIORITIES) - 1)]
    flags = [
        (F.col("o_orderpriority") == value).cast("int").alias(name)
        for name, value in zip(names, PRIORITIES, strict=False)
    ]
    encoded = t.orders.select("o_orderkey", *flags)
    return encoded.select("o_orderkey", fn.one_hot_index(names).alias("category"))


@query(
    "vector_sqdist",
    """SELECT vec_id,
              round(list_sum([pow(CAST(embedding[i] AS DOUBLE)
                                  - CAST(embedding[len(embedding) + 1 - i] AS DOUBLE), 2)
                              FOR i IN range(1, len(embedding) + 1)]), 6) AS distance
       FROM embeddings""",
)
def vector_sqdist(t: Tables) -> DataFrame:
    """Distance of every vector to its mirror image."""
    vector = F.col("embedding")
    distance = F.round(fn.squared_distance(vector, F.reverse(vector)), 6)
    return t.embeddings.select("vec_id", distance.alias("distance"))

"""The registered queries of the operators: thin, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywood.llm import (
    decontaminate,
    hidden_markov,
    licences,
    neighbours,
    packing,
    prefix_trie,
    progressive_centroids,
    sharding,
    simhash,
    token_counts,
    token_groups,
    toxicity,
    url_models,
)
from tallywood.llm.frames import id_remainder, shipped, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, folder) under a name, with its SQL twin."""

    def register(build):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            shipped(spark)
            return build(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_best_fit_packing")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return packing.pack(docs, vocabulary("word_bpe_49k.json")).drop("ids")


URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


@query("op2_url_language_models", url_models.judge_sql(URL_RULES))
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return url_models.judge(table(spark, folder, "pages"), URL_RULES)


@query("op3_simhash_near_duplicates")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, folder, "documents"))
    return found.select(
        "doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id"
    )


@query("op4_hidden_markov_scores")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return hidden_markov.hidden_markov_scores(docs, id_remainder("doc_id", 5) == 1)


@query("op5_toxicity")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels")
    machine = toxicity.train(docs, labels.where(id_remainder("doc_id", 4) != 2))
    rated = toxicity.score(docs, machine).select("row.doc_id", "score")
    return rated.select(
        "doc_id", F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query("op6_token_counts")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return token_counts.count_tokens(docs, vocabulary("byte_bpe_50k.json"), limit=1024)


@query(
    "op7_benchmark_decontamination",
    r"""
    WITH pattern AS (SELECT '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+' AS word),
    upper_lower AS (
      SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS u, 'abcdefghijklmnopqrstuvwxyz' AS l
    ),
    d AS (
      SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), u, l), word) AS w
      FROM documents, pattern, upper_lower
    ),
    b AS (
      SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
        regexp_extract_all(translate(coalesce(text, ''), u, l), word) AS w
      FROM benchmark, pattern, upper_lower
    ),
    windows AS (
      SELECT DISTINCT item, least(10, len(w)) AS n,
        unnest(list_transform(range(1, len(w) - least(10, len(w)) + 2),
          lambda i: array_to_string(w[i:i + least(10, len(w)) - 1], ' '))) AS passage
      FROM b WHERE len(w) > 0
    ),
    lengths AS (SELECT DISTINCT n FROM windows),
    places AS (
      SELECT r, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, lengths WHERE len(w) >= n
    ),
    found AS (
      SELECT r, p.n, i, item
      FROM (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS passage FROM places) p
      JOIN windows USING (n, passage)
    ),
    hit AS (
      SELECT r, count(DISTINCT j) AS n_hit
      FROM (SELECT r, unnest(range(i, i + n)) AS j FROM found) GROUP BY r
    ),
    items AS (
      SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids
      FROM found GROUP BY r
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
      CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
      coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
    """,
)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.search(
        table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark")
    )
    return found.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        decontaminate.digest("items").alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op8_learned_partition_search")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query("op9_virtual_slot_shards")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(table(spark, folder, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )


@query("op10_licence_scan")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "row.doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
        "score",
    )


@query("op11_progressive_centroids", progressive_centroids.cluster_sql())
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return progressive_centroids.cluster(table(spark, folder, "embeddings"))


@query("op12_shingle_groups", token_groups.similar_sql(words=4, percent=85))
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return token_groups.similar_documents(table(spark, folder, "documents"), words=4, percent=85)


@query("op13_conversation_trie", prefix_trie.trie_sql())
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, folder, "conversations"))

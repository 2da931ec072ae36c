"""One document of each SimHash group: what the near-duplicate operator is for in a pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.llm.simhash import simhash_components
from tallywood.plans.scratch import materialized


def one_of_each(docs: DataFrame, words: int = 3) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any others) that stay: one of each group.

    Groups are those of ``simhash_components``: fingerprints over shingles of ``words``
    words, linked at three differing bits or fewer. Of a group the row with the smallest
    doc_id stays, a null id only where there is no other; of rows alike in id and text
    (told by a hash of 64 bits) the one that is smallest in all columns.

    Texts without words, null ones too, are one group. All columns come back as they
    were; no rows give no rows.
    """
    key = F.xxhash64("doc_id", "text").alias("key")
    rows = docs.select(
        key, F.col("doc_id").isNull().alias("no_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("id"),
    ).groupBy("key").agg(
        F.min(F.struct("no_id", "id")).alias("order"), F.count(F.lit(1)).alias("alike")
    )
    groups = simhash_components(docs.select(key.alias("doc_id"), "text"), words)
    labels = groups.groupBy(F.col("doc_id").alias("key")).agg(F.first("component_id").alias("component"))
    placed = materialized(rows.join(labels, "key"), "placed")
    stay = placed.groupBy("component").agg(F.min(F.struct("order", "key"))["key"].alias("stays"))
    # Rows that nothing is to be done with are not listed: most stay, and alone.
    marks = placed.join(stay, "component").select("key", (F.col("key") == F.col("stays")).alias("kept"), "alike")
    marks = materialized(marks.where("NOT kept OR alike > 1").select("key", "kept"), "marks")
    rest = docs.select(key, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    alone = rest.join(marks, "key", "left_anti").select("row.*")
    repeated = marks.where("kept")
    if repeated.isEmpty():
        return alone
    one = rest.join(repeated, "key").groupBy("key").agg(F.min("row").alias("row"))
    return alone.unionAll(one.select("row.*"))

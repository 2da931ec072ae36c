"""Recommendation from what customers bought."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.learning import factors, jobs, recommend
from tallywood.plans import find_heavy, materialized
from tallywood.queries.registry import Tables, query
from tallywood.queries.relational import ALIAS_SQL, part_aliases

PLAYS_SQL = """SELECT o_custkey AS "user", l_partkey AS item, CAST(l_quantity AS BIGINT) AS plays
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
PAIRS_SQL = f"""SELECT "user", item, CAST(sum(plays) AS BIGINT) AS plays
                FROM ({PLAYS_SQL}) GROUP BY "user", item"""


def plays(t: Tables) -> DataFrame:
    buyers = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return t.lineitem.join(buyers, "l_orderkey").select(
        F.col("o_custkey").alias("user"),
        F.col("l_partkey").alias("item"),
        F.col("l_quantity").cast("bigint").alias("plays"),
    )


def pairs(t: Tables) -> DataFrame:
    return recommend.interaction_counts(plays(t), "user", "item", "plays")


# One pair in ten is held out; which one follows from the pair itself.
HELD_OUT_SQL = '("user" * 7 + item * 13) % 10 = 0'


def holdout(whole: DataFrame) -> tuple[DataFrame, DataFrame]:
    held_out = F.pmod(F.col("user") * 7 + F.col("item") * 13, F.lit(10)) == 0
    return whole.where(~held_out), whole.where(held_out)


def written_pairs(t: Tables) -> DataFrame:
    """The pairs as a table of their own, for queries that read them several times."""
    return materialized(pairs(t), "pairs")


@query(
    "interaction_counts",
    f"""SELECT "user", coalesce(alias, p.item) AS item, CAST(sum(plays) AS BIGINT) AS plays
        FROM ({PLAYS_SQL}) p LEFT JOIN ({ALIAS_SQL}) a ON p.item = a.item
        GROUP BY 1, 2""",
)
def interaction_counts(t: Tables) -> DataFrame:
    return recommend.interaction_counts(plays(t), "user", "item", "plays", part_aliases(t))


@query(
    "cross_candidates",
    """SELECT (SELECT max(c_custkey) FROM customer) AS "user", p_partkey AS item FROM part""",
)
def cross_candidates(t: Tables) -> DataFrame:
    newest = t.customer.agg(F.max("c_custkey").alias("user")).head()["user"]
    items = t.part.select(F.col("p_partkey").alias("item"))
    return recommend.candidates(items, "item", "user", newest)


POPULARITY_SQL = f"""SELECT item, CAST(sum(plays) AS BIGINT) AS prediction
                     FROM ({PAIRS_SQL}) WHERE NOT ({HELD_OUT_SQL}) GROUP BY item"""


@query("popularity_scores", POPULARITY_SQL)
def popularity_scores(t: Tables) -> DataFrame:
    train, _ = holdout(pairs(t))
    return recommend.popularity(train, "item", "plays")


@query(
    "popularity_predict",
    f"""SELECT p."user", p.item, CAST(prediction AS DOUBLE) AS prediction
        FROM ({PAIRS_SQL}) p LEFT JOIN ({POPULARITY_SQL}) s ON p.item = s.item""",
)
def popularity_predict(t: Tables) -> DataFrame:
    whole = written_pairs(t)
    train, _ = holdout(whole)
    scores = recommend.popularity(train, "item", "plays")
    found = recommend.predict_popularity(whole.select("user", "item"), scores, "item")
    return found.withColumn("prediction", F.col("prediction").cast("double"))


@query(
    "popularity_left_join",
    """SELECT l_orderkey, l_linenumber, item, CAST(prediction AS DOUBLE) AS prediction
       FROM (SELECT l_orderkey, l_linenumber, l_partkey AS item FROM lineitem)
       LEFT JOIN (SELECT l_partkey AS item, CAST(sum(l_linenumber) AS BIGINT) AS prediction
                  FROM lineitem WHERE l_quantity > 45 GROUP BY l_partkey) USING (item)""",
)
def popularity_left_join(t: Tables) -> DataFrame:
    """Items that large orders never asked for have no score."""
    large = t.lineitem.where("l_quantity > 45").withColumnRenamed("l_partkey", "item")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("item"))
    scores = recommend.popularity(large, "item", "l_linenumber")
    found = recommend.predict_popularity(lines, scores, "item")
    return found.withColumn("prediction", F.col("prediction").cast("double"))


NEGATIVES_SQL = f"""
    WITH pos AS (SELECT DISTINCT "user", item FROM ({PAIRS_SQL}) WHERE {HELD_OUT_SQL}),
         cat AS (SELECT item, row_number() OVER (ORDER BY item) - 1 AS at
                 FROM (SELECT DISTINCT item FROM ({PAIRS_SQL}))),
         size AS (SELECT count(*) AS n,
                         CASE WHEN count(*) % {recommend.STRIDES[0]} <> 0
                              THEN {recommend.STRIDES[0]}
                              WHEN count(*) % {recommend.STRIDES[1]} <> 0
                              THEN {recommend.STRIDES[1]}
                              ELSE {recommend.STRIDES[2]} END AS stride FROM cat),
         users AS (SELECT "user", count(*) AS wanted FROM pos GROUP BY "user"),
         draws AS (SELECT "user", wanted,
                          unnest(range(0, least(2 * wanted, n))) AS draw, n, stride
                   FROM users, size),
         others AS (SELECT d."user", cat.item, wanted,
                           row_number() OVER (PARTITION BY d."user" ORDER BY draw) AS k
                    FROM draws d JOIN cat
                      ON cat.at = (d."user" * {recommend.USER_STEP} + draw * stride) % n
                    WHERE NOT EXISTS (SELECT 1 FROM pos WHERE pos."user" = d."user"
                                      AND pos.item = cat.item)),
         neg AS (SELECT "user", item FROM others WHERE k <= wanted)
"""


@query("negative_samples", f"""{NEGATIVES_SQL} SELECT "user", item FROM neg""")
def negative_samples(t: Tables) -> DataFrame:
    whole = written_pairs(t)
    _, held_out = holdout(whole)
    return recommend.sample_negatives(held_out, whole, "user", "item")


@query(
    "mean_user_auc_popularity",
    f"""{NEGATIVES_SQL},
         s AS ({POPULARITY_SQL}),
         u AS (SELECT a."user", count(*) AS total,
                      count(*) FILTER (WHERE a.prediction > b.prediction) AS correct
               FROM (SELECT "user", prediction FROM pos LEFT JOIN s USING (item)) a
               JOIN (SELECT "user", prediction FROM neg LEFT JOIN s USING (item)) b
                 ON a."user" = b."user"
               GROUP BY a."user")
        SELECT round(avg(correct / total), 9) AS auc, count(*) AS n_users FROM u""",
)
def mean_user_auc_popularity(t: Tables) -> DataFrame:
    whole = written_pairs(t)
    train, held_out = holdout(whole)
    scores = recommend.popularity(train, "item", "plays")

    def predict(rows: DataFrame) -> DataFrame:
        return recommend.predict_popularity(rows, scores, "item")

    negatives = recommend.sample_negatives(held_out, whole, "user", "item")
    found = recommend.mean_user_auc(
        held_out, negatives, predict, "user", "item", find_heavy(held_out, ["user"])
    )
    return found.select(F.round("auc", 9).alias("auc"), "n_users")


def _als(train: DataFrame):
    return recommend.fit_als(train, "user", "item", "plays", seed=11)


@query("als_predict")
def als_predict(t: Tables) -> DataFrame:
    train, held_out = holdout(written_pairs(t))
    return _als(train).transform(held_out.select("user", "item"))


@query("als_top_n")
def als_top_n(t: Tables) -> DataFrame:
    """Five items for the customer with the most orders."""
    model = _als(pairs(t))
    best = t.orders.groupBy(F.col("o_custkey").alias("user")).count()
    one = best.orderBy(F.desc("count"), "user").limit(1)
    return recommend.recommend(model, one, "user", "item", 5)


@query(
    "als_factors_solve_their_equations",
    f"""SELECT "user", count(*) AS n, true AS solved FROM ({PAIRS_SQL})
        WHERE NOT ({HELD_OUT_SQL}) AND plays > 0 GROUP BY 1""",
)
def als_factors_solve_their_equations(t: Tables) -> DataFrame:
    """Every user's factors against the sums of all they bought; single precision is 1e-3 here."""
    train, _ = holdout(written_pairs(t))
    model = _als(train)
    found = factors.equation_residuals(
        train, model.userFactors, model.itemFactors, "user", "item", "plays",
        model.rank, recommend.ALS_SMALL["regParam"], recommend.ALS_SMALL["alpha"],
    )
    return found.select(F.col("user").cast("bigint"), "n", (F.col("residual") < 1e-3).alias("solved"))


FLAGS = ["A", "N", "R"]
PROFILE_SQL = ", ".join(
    f"CAST(sum(CASE WHEN l_returnflag = '{f}' THEN l_quantity ELSE 0 END) AS DOUBLE) AS q{f}" for f in FLAGS
)


def profile(rows: DataFrame, owner: str, name: str) -> DataFrame:
    """Quantities per return flag as a vector."""
    flag, quantity = F.coalesce("l_returnflag", F.lit("")), F.coalesce("l_quantity", F.lit(0.0))
    sums = [F.sum(F.when(flag == f, quantity).otherwise(0.0)) for f in FLAGS]
    return rows.groupBy(F.col(owner).alias(name)).agg(F.array(*sums).alias("v"))


@query(
    "profile_top_n",
    f"""WITH q AS (SELECT o_custkey AS query, {PROFILE_SQL} FROM lineitem
                   JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey IS NOT NULL GROUP BY 1),
             i AS (SELECT l_partkey AS item, {PROFILE_SQL} FROM lineitem
                   WHERE l_partkey IS NOT NULL GROUP BY 1),
             s AS (SELECT query, item, {" + ".join(f"q.q{f} * i.q{f}" for f in FLAGS)} AS score FROM q, i),
             r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, item) AS k FROM s)
        SELECT query, CAST(k AS INTEGER) AS rank, item, score FROM r WHERE k <= 5""",
)
def profile_top_n(t: Tables) -> DataFrame:
    """Five parts for every customer, by products of what is bought and returned of either.

    Blocks of 256 parts, so that the bound on the products closes queries at small sizes too.
    """
    buyers = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    customers = profile(t.lineitem.join(buyers, "l_orderkey"), "o_custkey", "query")
    return factors.top_products(customers, profile(t.lineitem, "l_partkey", "item"), 5, block=256)


@query(
    "als_top_n_is_sorted",
    "SELECT CAST(5 AS BIGINT) AS n, true AS one_user, true AS different_items, true AS known_items",
)
def als_top_n_is_sorted(t: Tables) -> DataFrame:
    found = als_top_n(t)
    known = found.join(
        t.part.select(F.col("p_partkey").alias("item"), F.lit(True).alias("there")), "item", "left"
    )
    return known.agg(
        F.count(F.lit(1)).alias("n"), (F.count_distinct("user") == 1).alias("one_user"),
        (F.count_distinct("item") == F.count(F.lit(1))).alias("different_items"),
        F.bool_and(F.col("there").isNotNull()).alias("known_items"),
    )


@query(
    "als_scores_every_held_out_pair",
    f"""SELECT "user", item FROM ({PAIRS_SQL}) WHERE {HELD_OUT_SQL}""",
)
def als_scores_every_held_out_pair(t: Tables) -> DataFrame:
    return als_predict(t).select(F.col("user").cast("bigint"), F.col("item").cast("bigint"))


@query("mean_user_auc_als")
def mean_user_auc_als(t: Tables) -> DataFrame:
    whole = written_pairs(t)
    train, held_out = holdout(whole)
    model = _als(train)
    negatives = recommend.sample_negatives(held_out, whole, "user", "item")
    return recommend.mean_user_auc(
        held_out, negatives, model.transform, "user", "item", find_heavy(held_out, ["user"])
    )


@query("recommender_auc_job")
def recommender_auc_job(t: Tables) -> DataFrame:
    """The whole recommender job: popularity and factors on a held-out tenth of the pairs."""
    return jobs.recommender_auc(plays(t), part_aliases(t), seed=5)

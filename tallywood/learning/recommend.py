"""Recommendation from interaction counts, and its evaluation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.operators.joins import resolve_alias
from tallywood.plans import (
    HeavyKeys,
    checkpoint_root,
    heavy_among,
    materialized,
    number_rows,
    number_within,
    running_sums,
)
from tallywood.plans.skew import HEAVY_ROWS

# The two parameter sets of the implicit-feedback model.
ALS_SMALL = {"rank": 10, "regParam": 0.01, "alpha": 1.0, "maxIter": 5}
ALS_LARGE = {"rank": 40, "regParam": 0.01, "alpha": 1.0, "maxIter": 20}

# Step widths of the walk over the items; one that divides the number of items
# would visit only some of them, and no number of items below their product is
# divisible by all.
STRIDES = (7919, 7907, 7901)
USER_STEP = 31


def interaction_counts(
    plays: DataFrame,
    user: str,
    item: str,
    count: str,
    aliases: DataFrame | None = None,
) -> DataFrame:
    """Summed count per (user, item); ``aliases`` has columns ``item``, ``alias``."""
    if aliases is not None:
        plays = resolve_alias(plays, item, aliases, "item", "alias")
    return plays.groupBy(user, item).agg(F.sum(count).alias(count))


def popularity(train: DataFrame, item: str, count: str) -> DataFrame:
    """Total count per item as ``prediction``."""
    return train.groupBy(item).agg(F.sum(count).alias("prediction"))


def predict_popularity(pairs: DataFrame, scores: DataFrame, item: str) -> DataFrame:
    """Pairs with their item's popularity; null for an item never seen."""
    return pairs.join(scores, item, "left")


def fit_als(
    train: DataFrame, user: str, item: str, count: str, seed: int, **params
) -> ALSModel:
    """Implicit-feedback factorisation; user and item are integers.

    The fit reads the rows once and keeps its own blocks of them, so they are not cached.
    """
    checkpoint_root(train.sparkSession)
    als = ALS(
        userCol=user,
        itemCol=item,
        ratingCol=count,
        implicitPrefs=True,
        seed=seed,
        **{**ALS_SMALL, **params},
    )
    return als.fit(train)


def recommend(model: ALSModel, users: DataFrame, user: str, item: str, n: int) -> DataFrame:
    """Top items of the given users, as one row per user and item."""
    found = model.recommendForUserSubset(users.select(user), n)
    return found.select(user, F.inline("recommendations")).withColumnRenamed(
        "rating", "prediction"
    )


def candidates(items: DataFrame, item: str, user: str, user_id: int) -> DataFrame:
    """One user with every item."""
    return items.select(F.lit(user_id).cast("bigint").alias(user), item)


def sample_negatives(
    positives: DataFrame,
    items: DataFrame,
    user: str,
    item: str,
    seed: int = 0,
    min_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Items a user has not chosen: as many as chosen ones, or all there are.

    Every user walks the numbered items from an own start in steps that visit
    each item once. The first 2n places of the walk hold at most the user's n
    positives, hence at least n others (or the walk is complete), so two draws
    per positive are always enough. The draws are made from the positives'
    rows, wherever they are, and not per user.
    """
    pairs = materialized(positives.select(user, item).distinct(), "positives")
    wanted = pairs.groupBy(user).agg(F.count(F.lit(1)).alias("_wanted"))
    heavy = heavy_among(wanted, [user], "_wanted", min_rows)
    catalog = number_rows(items.select(item).distinct(), [item], "_at")
    n_items = catalog.count()
    if not n_items:  # nothing to draw from
        return pairs.limit(0)
    stride = next(s for s in STRIDES if n_items % s)
    placed = number_within(pairs, [user], [item], "_place", heavy)
    place = F.col("_place")
    draws = placed.select(
        user, F.explode(F.array(2 * place, 2 * place + 1)).alias("_draw")
    ).where(F.col("_draw") < n_items)
    # Reduced first: the product of a large id would not fit.
    own = F.pmod(F.col(user), F.lit(n_items))
    walk = own * USER_STEP + F.col("_draw") * stride + seed
    drawn = draws.withColumn("_at", F.pmod(walk, F.lit(n_items))).join(catalog, "_at").drop("_at")
    others = drawn.join(pairs, [user, item], "left_anti")
    ranked = number_within(others, [user], ["_draw"], "_rank", heavy)
    return (
        ranked.join(wanted, user)
        .where(F.col("_rank") < F.col("_wanted"))
        .select(user, item)
    )


def user_auc(
    positives: DataFrame,
    negatives: DataFrame,
    predict: Callable[[DataFrame], DataFrame],
    user: str,
    item: str,
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """Per user: pairs of a positive and a negative, those ranked right, their share.

    A pair is right when the positive scores higher; one with a missing score
    is not. The pairs are never made: a positive is right with as many
    negatives as score below it, which is a running count along the scores.
    ``heavy`` names the users with very many rows.
    """

    def scored(pairs: DataFrame, is_positive: int) -> DataFrame:
        return predict(pairs.select(user, item)).select(
            user,
            "prediction",
            F.lit(is_positive).cast("long").alias("pos"),
            F.lit(1 - is_positive).cast("long").alias("neg"),
        )

    per_score = (
        scored(positives, 1)
        .unionAll(scored(negatives, 0))
        .groupBy(user, "prediction")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .withColumn(
            "_scored_neg", F.when(F.col("prediction").isNotNull(), F.col("neg")).otherwise(0)
        )
    )
    running = running_sums(
        per_score, ["prediction"], {"_through": "_scored_neg"}, [user], heavy
    )
    below = F.col("_through") - F.col("_scored_neg")
    right = F.when(F.col("prediction").isNotNull(), F.col("pos") * below).otherwise(0)
    totals = running.groupBy(user).agg(
        (F.sum("pos") * F.sum("neg")).alias("total"), F.sum(right).alias("correct")
    )
    return totals.where(F.col("total") > 0).withColumn("auc", F.col("correct") / F.col("total"))


def mean_user_auc(
    positives: DataFrame,
    negatives: DataFrame,
    predict: Callable[[DataFrame], DataFrame],
    user: str,
    item: str,
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """Mean of ``user_auc`` over the users."""
    per_user = user_auc(positives, negatives, predict, user, item, heavy)
    return per_user.agg(F.avg("auc").alias("auc"), F.count(F.lit(1)).alias("n_users"))

"""Evaluation reports over rule-made predictions on whole tables.

Binary cases take "returned" as the label (positive class 1) and a discount of
at least 5 % as the prediction, with the quantity as a score.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.learning import evaluate
from tallywood.queries.registry import Tables, query

BINARY_SQL = """SELECT CAST(l_returnflag = 'R' AS DOUBLE) AS label,
                       CAST(l_discount >= 0.05 AS DOUBLE) AS prediction,
                       l_quantity AS score FROM lineitem"""


def _binary(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label"),
        F.when(F.col("l_discount") >= 0.05, 1.0).otherwise(0.0).alias("prediction"),
        F.col("l_quantity").alias("score"),
    )


@query(
    "binary_outcome_report",
    f"""SELECT count(*) AS total,
               count(*) FILTER (WHERE label = prediction) AS correct,
               count(*) FILTER (WHERE label <> prediction) AS wrong,
               count(*) FILTER (WHERE label <> prediction) / count(*) AS ratio_wrong,
               count(*) FILTER (WHERE label = prediction) / count(*) AS ratio_correct,
               count(*) FILTER (WHERE label = 1 AND prediction = 1) / count(*) AS ratio_tp,
               count(*) FILTER (WHERE label = 0 AND prediction = 1) / count(*) AS ratio_fp,
               count(*) FILTER (WHERE label = 0 AND prediction = 0) / count(*) AS ratio_tn,
               count(*) FILTER (WHERE label = 1 AND prediction = 0) / count(*) AS ratio_fn
        FROM ({BINARY_SQL})""",
)
def binary_outcome_report(t: Tables) -> DataFrame:
    return evaluate.outcome_report(_binary(t))


@query(
    "area_under_roc",
    f"""SELECT round((count(*) FILTER (WHERE label = 1 AND prediction = 1)
                        / count(*) FILTER (WHERE label = 1)
                      + 1 - count(*) FILTER (WHERE label = 0 AND prediction = 1)
                        / count(*) FILTER (WHERE label = 0)) / 2, 9) AS area_under_roc
        FROM ({BINARY_SQL})""",
)
def area_under_roc(t: Tables) -> DataFrame:
    areas = evaluate.curve_areas(_binary(t), "prediction")
    return areas.select(F.round("area_under_roc", 9).alias("area_under_roc"))


@query(
    "area_under_pr",
    f"""WITH c AS (SELECT CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS DOUBLE) AS tp,
                          CAST(count(*) FILTER (WHERE prediction = 1) AS DOUBLE) AS yes,
                          CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS p,
                          CAST(count(*) AS DOUBLE) AS n FROM ({BINARY_SQL}))
        SELECT round(tp / p * (tp / yes) + (1 - tp / p) * (tp / yes + p / n) / 2, 9)
                 AS area_under_pr FROM c""",
)
def area_under_pr(t: Tables) -> DataFrame:
    areas = evaluate.curve_areas(_binary(t), "prediction")
    return areas.select(F.round("area_under_pr", 9).alias("area_under_pr"))


CURVE_SQL = f"""SELECT threshold, CAST(pos AS DOUBLE) AS pos, CAST(neg AS DOUBLE) AS neg,
                       CAST(sum(pos) OVER (ORDER BY threshold DESC) AS DOUBLE) AS tp,
                       CAST(sum(neg) OVER (ORDER BY threshold DESC) AS DOUBLE) AS fp,
                       CAST(sum(pos) OVER () AS DOUBLE) AS p, CAST(sum(neg) OVER () AS DOUBLE) AS n
                FROM (SELECT score AS threshold, sum(label) AS pos, sum(1 - label) AS neg
                      FROM ({BINARY_SQL}) GROUP BY score)"""


@query(
    "score_curve_areas",
    f"""SELECT round(sum(neg * (tp + tp - pos) / 2) / any_value(p) / any_value(n), 9)
                 AS area_under_roc,
               round(sum(pos * (tp / (tp + fp)
                                + CASE WHEN tp + fp > pos + neg
                                       THEN (tp - pos) / (tp + fp - pos - neg)
                                       ELSE tp / (tp + fp) END) / 2) / any_value(p), 9)
                 AS area_under_pr
        FROM ({CURVE_SQL})""",
)
def score_curve_areas(t: Tables) -> DataFrame:
    areas = evaluate.curve_areas(_binary(t), "score")
    return areas.select(*[F.round(c, 9).alias(c) for c in areas.columns])


@query(
    "threshold_curve",
    f"""SELECT threshold, round(tp / (tp + fp), 9) AS "precision", round(tp / p, 9) AS recall,
               round(2 * tp / (tp + fp + p), 9) AS f1
        FROM ({CURVE_SQL})""",
)
def threshold_curve(t: Tables) -> DataFrame:
    curve = evaluate.threshold_curve(_binary(t), "score")
    return curve.select(
        "threshold", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")]
    )


MULTI_SQL = """SELECT CAST(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END
                           AS DOUBLE) AS label,
                      CAST(CASE WHEN o_totalprice < 150000 THEN 0 WHEN o_totalprice < 300000 THEN 1
                                ELSE 2 END AS DOUBLE) AS prediction FROM orders"""


def _multi(t: Tables) -> DataFrame:
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    return t.orders.select(
        F.when(status == "F", 0.0).when(status == "O", 1.0).otherwise(2.0).alias("label"),
        F.when(price < 150000, 0.0).when(price < 300000, 1.0).otherwise(2.0).alias("prediction"),
    )


@query(
    "multiclass_accuracy_f1",
    f"""WITH m AS ({MULTI_SQL}), k AS (SELECT DISTINCT label AS c FROM m),
             s AS (SELECT c, count(*) FILTER (WHERE label = c) AS actual,
                          count(*) FILTER (WHERE prediction = c) AS said,
                          count(*) FILTER (WHERE label = c AND prediction = c) AS hit
                   FROM m CROSS JOIN k GROUP BY c)
        SELECT round(sum(hit) / sum(actual), 9) AS accuracy,
               round(sum(actual * (2.0 * hit / (actual + said))) / sum(actual), 9) AS f1 FROM s""",
)
def multiclass_accuracy_f1(t: Tables) -> DataFrame:
    found = evaluate.accuracy_f1(_multi(t))
    return found.select(*[F.round(c, 9).alias(c) for c in found.columns])


@query(
    "confusion_long",
    f"SELECT label, prediction, count(*) AS n FROM ({MULTI_SQL}) GROUP BY label, prediction",
)
def confusion_long(t: Tables) -> DataFrame:
    return evaluate.confusion(_multi(t))


@query(
    "confusion_matrix",
    f"""SELECT label, count(*) FILTER (WHERE prediction = 0) AS "0.0",
               count(*) FILTER (WHERE prediction = 1) AS "1.0",
               count(*) FILTER (WHERE prediction = 2) AS "2.0"
        FROM ({MULTI_SQL}) GROUP BY label ORDER BY label""",
)
def confusion_matrix(t: Tables) -> DataFrame:
    return evaluate.confusion_matrix(_multi(t), [0.0, 1.0, 2.0])


@query(
    "regression_metrics",
    """WITH r AS (SELECT l_extendedprice AS y, l_quantity * 1500 AS f FROM lineitem),
            m AS (SELECT avg(y) AS mean FROM r)
       SELECT round(avg((y - f) * (y - f)) / 1e6, 6) AS mse,
              round(sqrt(avg((y - f) * (y - f))), 6) AS rmse,
              round(1 - sum((y - f) * (y - f)) / sum((y - mean) * (y - mean)), 9) AS r2,
              round(avg(abs(y - f)), 6) AS mae,
              round(avg((f - mean) * (f - mean)) / 1e6, 6) AS explained_variance
       FROM r, m""",
)
def regression_metrics(t: Tables) -> DataFrame:
    """Squared measures are in millions."""
    lines = t.lineitem.select(
        F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 1500).alias("prediction")
    )
    return evaluate.regression_report(lines).select(
        F.round(F.col("mse") / 1e6, 6).alias("mse"),
        F.round("rmse", 6).alias("rmse"),
        F.round("r2", 9).alias("r2"),
        F.round("mae", 6).alias("mae"),
        F.round(F.col("explained_variance") / 1e6, 6).alias("explained_variance"),
    )

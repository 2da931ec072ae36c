"""Correlation, independence and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood import stats
from tallywood.learning.features import assemble
from tallywood.queries.registry import Tables, query

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _matrix_sql(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS i, '{b}' AS j, round(corr({a}, {b}), 6) AS corr FROM {source}"
        for a in columns
        for b in columns
    )


@query("pearson_matrix", _matrix_sql("lineitem", MEASURES))
def pearson_matrix(t: Tables) -> DataFrame:
    found = stats.pearson(t.lineitem, MEASURES)
    return found.select("i", "j", F.round("corr", 6).alias("corr"))


def _rank_sql(columns: list[str]) -> str:
    ranks = ", ".join(
        f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}"
        for c in columns
    )
    return f"(SELECT {ranks} FROM lineitem)"


RANKED = ["l_quantity", "l_extendedprice", "l_discount"]


@query("spearman_matrix", f"WITH r AS {_rank_sql(RANKED)} {_matrix_sql('r', RANKED)}")
def spearman_matrix(t: Tables) -> DataFrame:
    found = stats.spearman(t.lineitem, RANKED)
    return found.select("i", "j", F.round("corr", 6).alias("corr"))


def _chi_square_sql(features: list[str], label: str, digits: int = 6) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{f}' AS feature,
                   round(sum((o - r * c / n) * (o - r * c / n) / (r * c / n)), {digits}) AS statistic,
                   CAST((count(DISTINCT v) - 1) * (count(DISTINCT l) - 1) AS BIGINT) AS dof
            FROM (SELECT rows.v, columns.l, r, c, n, coalesce(o, 0) AS o
                  FROM (SELECT {f} AS v, CAST(count(*) AS DOUBLE) AS r FROM lineitem GROUP BY 1) rows
                  CROSS JOIN (SELECT {label} AS l, CAST(count(*) AS DOUBLE) AS c
                              FROM lineitem GROUP BY 1) columns
                  CROSS JOIN (SELECT CAST(count(*) AS DOUBLE) AS n FROM lineitem)
                  LEFT JOIN (SELECT {f} AS v, {label} AS l, CAST(count(*) AS DOUBLE) AS o
                             FROM lineitem GROUP BY 1, 2) cells
                    ON rows.v = cells.v AND columns.l = cells.l)"""
        for f in features
    )


@query("chi_square_stat", _chi_square_sql(["l_linenumber", "l_linestatus"], "l_returnflag"))
def chi_square_stat(t: Tables) -> DataFrame:
    found = stats.chi_square(t.lineitem, ["l_linenumber", "l_linestatus"], "l_returnflag")
    return found.select("feature", F.round("statistic", 6).alias("statistic"), "dof")


def _p_value_sql(statistics: str) -> str:
    """One less the series of the lower incomplete gamma function, term by term in logarithms."""
    return f"""
        SELECT feature, round(statistic, 6) AS statistic, dof,
               round(1 - sum(exp((a + n) * ln(x) - x - lgamma(a + n + 1))), 9) AS p_value
        FROM (SELECT *, statistic / 2 AS x, dof / 2.0 AS a,
                     unnest(range(CAST(2 * statistic AS BIGINT) + 500)) AS n
              FROM ({statistics}))
        GROUP BY feature, statistic, dof"""


@query(
    "chi_square_p_value",
    _p_value_sql(_chi_square_sql(["l_linenumber", "l_linestatus"], "l_returnflag = 'R'", 15)),
)
def chi_square_p_value(t: Tables) -> DataFrame:
    lines = t.lineitem.withColumn("returned", F.col("l_returnflag") == "R")
    found = stats.chi_square_p_values(lines, ["l_linenumber", "l_linestatus"], "returned")
    return found.select(
        "feature", F.round("statistic", 6).alias("statistic"), "dof",
        (F.round("p_value", 9) + 0.0).alias("p_value"),
    )


@query(
    "p_values_follow_from_the_statistic",
    f"""SELECT feature, statistic, dof, true AS p_value_follows
        FROM ({_chi_square_sql(["l_linenumber", "l_linestatus"], "l_returnflag = 'R'")})""",
)
def p_values_follow_from_the_statistic(t: Tables) -> DataFrame:
    """Statistics as SQL has them; the p-value of an even number of degrees of freedom is
    exp(-x/2) times the first terms of the series of exp(x/2), one of one degree erfc."""
    found = chi_square_p_value(t)
    half = F.col("statistic") / 2
    terms = F.sequence(F.lit(0), F.greatest((F.col("dof") / 2).cast("int") - 1, F.lit(0)))
    series = F.exp(-half) * F.aggregate(
        terms, F.lit(0.0), lambda a, k: a + F.pow(half, k) / F.factorial(k.cast("int"))
    )
    follows = F.when(F.col("dof") % 2 == 0, F.abs(F.col("p_value") - series) < 1e-6).otherwise(
        F.col("p_value").between(0, 1)
    )
    return found.select(
        "feature", F.round("statistic", 6).alias("statistic"), "dof",
        follows.alias("p_value_follows"),
    )


def _summary_sql(weight: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT {i} AS dim, round(m, 9) AS mean, round(s2 / (w - w2 / w), 9) AS variance
            FROM (SELECT sum({weight}) AS w, sum(({weight}) * ({weight})) AS w2,
                         any_value(m) AS m,
                         sum(({weight}) * ({c} - m) * ({c} - m)) AS s2
                  FROM lineitem,
                       (SELECT sum(({weight}) * {c}) / sum({weight}) AS m FROM lineitem))"""
        for i, c in enumerate(["l_quantity", "l_discount", "l_tax"])
    )


def _rounded(summary: DataFrame) -> DataFrame:
    return summary.select(
        "dim", F.round("mean", 9).alias("mean"), F.round("variance", 9).alias("variance")
    )


@query("weighted_summary", _summary_sql("CAST(l_linenumber AS DOUBLE)"))
def weighted_summary(t: Tables) -> DataFrame:
    rows = assemble(t.lineitem, ["l_quantity", "l_discount", "l_tax"])
    weighted = rows.withColumn("weight", F.col("l_linenumber").cast("double"))
    return _rounded(stats.vector_summary(weighted, "features", "weight"))


@query("vector_summary", _summary_sql("CAST(1 AS DOUBLE)"))
def vector_summary(t: Tables) -> DataFrame:
    rows = assemble(t.lineitem, ["l_quantity", "l_discount", "l_tax"])
    return _rounded(stats.vector_summary(rows, "features"))


@query(
    "prior_baseline_accuracy",
    """WITH s AS (SELECT o_orderstatus AS c, o_orderkey % 10 < 9 AS train FROM orders),
            a AS (SELECT c, count(*) / (SELECT count(*) FROM s WHERE train) AS p
                  FROM s WHERE train GROUP BY c),
            b AS (SELECT c, count(*) / (SELECT count(*) FROM s WHERE NOT train) AS p
                  FROM s WHERE NOT train GROUP BY c)
       SELECT round(sum(a.p * b.p), 9) AS accuracy FROM a JOIN b USING (c)""",
)
def prior_baseline_accuracy(t: Tables) -> DataFrame:
    train = F.pmod("o_orderkey", F.lit(10)) < 9
    found = stats.baseline_accuracy(
        t.orders.where(train), t.orders.where(~train), "o_orderstatus"
    )
    return found.select(F.round("accuracy", 9).alias("accuracy"))

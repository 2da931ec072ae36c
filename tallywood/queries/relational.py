"""Rows, joins, groups, windows and rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.functions import parse_or
from tallywood.operators import groups, joins, pairs, ranking, rows, windows
from tallywood.queries.registry import Tables, query

# --- rows --------------------------------------------------------------------


@query(
    "project_rename_cast",
    """SELECT o_orderkey AS id, CAST(o_orderkey AS VARCHAR) AS id_text, o_totalprice AS loss,
              CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day
       FROM orders""",
)
def project_rename_cast(t: Tables) -> DataFrame:
    return rows.project(
        t.orders,
        {
            "id": "o_orderkey",
            "id_text": "o_orderkey",
            "loss": "o_totalprice",
            "day": F.col("o_orderdate").cast("date"),
        },
        {"id_text": "string", "day": "string"},
    )


@query(
    "select_by_name_rule",
    """SELECT CAST(l_orderkey AS DOUBLE) AS l_orderkey, CAST(l_partkey AS DOUBLE) AS l_partkey,
              CAST(l_suppkey AS DOUBLE) AS l_suppkey, CAST(l_linenumber AS DOUBLE) AS l_linenumber,
              l_quantity, l_extendedprice, l_discount, l_tax
       FROM lineitem""",
)
def select_by_name_rule(t: Tables) -> DataFrame:
    categorical = ("l_returnflag", "l_linestatus", "l_shipdate")
    return rows.select_by_name(t.lineitem, lambda c: not c.startswith(categorical), "double")


@query(
    "null_drop_fill",
    """SELECT l_orderkey, l_linenumber, l_returnflag,
              CASE WHEN l_discount = 0.05 THEN 0.0 ELSE l_discount END AS l_discount
       FROM lineitem WHERE l_returnflag <> 'N'""",
)
def null_drop_fill(t: Tables) -> DataFrame:
    gaps = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("l_returnflag"),
        F.nullif(F.col("l_discount"), F.lit(0.05)).alias("l_discount"),
    )
    return gaps.fillna(0.0, ["l_discount"]).dropna()


@query(
    "null_counts",
    """SELECT count(*) FILTER (WHERE l_returnflag = 'N') AS l_returnflag,
              count(*) FILTER (WHERE l_discount = 0.05) AS l_discount
       FROM lineitem""",
)
def null_counts(t: Tables) -> DataFrame:
    gaps = t.lineitem.select(
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("l_returnflag"),
        F.nullif(F.col("l_discount"), F.lit(0.05)).alias("l_discount"),
    )
    return rows.null_counts(gaps)


@query(
    "filter_predicates",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_discount
       FROM lineitem
       WHERE l_returnflag = 'R' AND NOT (l_linestatus = 'O') AND l_quantity > 10
         AND l_discount >= 0.03 AND l_linenumber IN (1, 2, 3)""",
)
def filter_predicates(t: Tables) -> DataFrame:
    return t.lineitem.where(
        (F.col("l_returnflag") == "R")
        & ~(F.col("l_linestatus") == "O")
        & (F.col("l_quantity") > 10)
        & (F.col("l_discount") >= 0.03)
        & F.col("l_linenumber").isin(1, 2, 3)
    ).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


def _dirty_events(t: Tables) -> DataFrame:
    """Numbers as text, unreadable where the event is an error."""
    text = F.when(F.col("event_type") == "error", F.concat(F.lit("bad"), F.col("event_id")))
    return t.events.select(
        "event_id",
        text.otherwise(F.col("user_id").cast("string")).alias("user_text"),
        F.when(F.col("event_type") == "error", "n/a")
        .otherwise(F.col("value").cast("string"))
        .alias("value_text"),
    )


@query(
    "parse_or_drop",
    """SELECT event_id, CAST(user_id AS INTEGER) AS user_id
       FROM events WHERE event_type <> 'error'""",
)
def parse_or_drop(t: Tables) -> DataFrame:
    parsed = rows.parse_or_drop(_dirty_events(t), "user_text", "int", "user_id")
    return parsed.select("event_id", "user_id")


@query(
    "parse_or_default",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 0.0 ELSE value END AS value
       FROM events""",
)
def parse_or_default(t: Tables) -> DataFrame:
    return _dirty_events(t).select(
        "event_id", parse_or(F.col("value_text"), "double", 0.0).alias("value")
    )


@query("bernoulli_sample")
def bernoulli_sample(t: Tables) -> DataFrame:
    return rows.bernoulli_sample(t.lineitem.select("l_orderkey", "l_linenumber"), 0.1, seed=7)


@query(
    "samples_are_subsets",
    """SELECT 'bernoulli' AS sample, true AS known, true AS once, true AS near_share
       UNION ALL SELECT 'stratified', true, true, true""",
)
def samples_are_subsets(t: Tables) -> DataFrame:
    """A sample has no row more often than the table, and about the asked share of them."""
    keys = ["l_orderkey", "l_linenumber"]
    flag = F.col("l_returnflag")
    shares = {
        "bernoulli": F.lit(0.1),
        "stratified": F.when(flag == "R", 1.0).when(flag == "N", 0.1675).otherwise(0.0),
    }
    out = None
    for name, sampled in (("bernoulli", bernoulli_sample(t)), ("stratified", stratified_sample(t))):
        lines = t.lineitem.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("there"), F.sum(shares[name]).alias("wanted")
        )
        both = lines.join(sampled.groupBy(*keys).agg(F.count(F.lit(1)).alias("times")), keys, "full")
        found = both.agg(
            F.lit(name).alias("sample"),
            F.bool_and(F.col("there").isNotNull()).alias("known"),
            F.bool_and(F.coalesce(F.col("times") <= F.col("there"), F.lit(True))).alias("once"),
            # Five standard deviations of the expected number, and a little.
            (
                F.abs(F.sum("times") - F.sum("wanted")) <= 5 * F.sqrt(F.sum("wanted")) + 5
            ).alias("near_share"),
        )
        out = found if out is None else out.unionAll(found)
    return out


@query(
    "splits_are_whole",
    """SELECT 'random' AS split, count(*) AS n_rows, true AS once FROM orders
       UNION ALL SELECT 'by key', count(*), true FROM orders""",
)
def splits_are_whole(t: Tables) -> DataFrame:
    """The parts of a split together have every row once."""
    orders = t.orders.select("o_orderkey")
    splits = {
        "random": rows.random_split(orders, [0.75, 0.25], seed=12345),
        "by key": rows.key_split(orders, ["o_orderkey"], [0.9, 0.1], seed=1),
    }
    out = None
    for name, (first, second) in splits.items():
        counted = first.unionAll(second).groupBy("o_orderkey").count()
        found = counted.agg(
            F.lit(name).alias("split"), F.sum("count").alias("n_rows"),
            F.bool_and(F.col("count") == 1).alias("once"),
        )
        out = found if out is None else out.unionAll(found)
    return out


@query("random_split_sizes")
def random_split_sizes(t: Tables) -> DataFrame:
    parts = rows.random_split(t.orders.select("o_orderkey"), [0.75, 0.25], seed=12345)
    sizes = [p.agg(F.lit(i).alias("part"), F.count("*").alias("n")) for i, p in enumerate(parts)]
    return sizes[0].unionAll(sizes[1])


@query(
    "key_split_is_whole",
    "SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_keys FROM lineitem",
)
def key_split_is_whole(t: Tables) -> DataFrame:
    """Both parts together have every row, and no key is in both."""
    parts = rows.key_split(t.lineitem.select("l_orderkey"), ["l_orderkey"], [0.9, 0.1], seed=1)
    counted = [groups.count_by(p, "l_orderkey") for p in parts]
    both = counted[0].unionAll(counted[1])
    return both.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"))


@query("key_split_sizes")
def key_split_sizes(t: Tables) -> DataFrame:
    parts = rows.key_split(t.orders.select("o_orderkey"), ["o_orderkey"], [0.9, 0.1], seed=1)
    sizes = [p.agg(F.lit(i).alias("part"), F.count("*").alias("n")) for i, p in enumerate(parts)]
    return sizes[0].unionAll(sizes[1])


@query(
    "modulo_split_counts",
    """SELECT CASE WHEN o_orderkey % 10 < 9 THEN 'train' ELSE 'test' END AS part, count(*) AS n
       FROM orders GROUP BY 1""",
)
def modulo_split_counts(t: Tables) -> DataFrame:
    part = F.when(F.pmod("o_orderkey", F.lit(10)) < 9, "train").otherwise("test")
    return groups.count_by(t.orders.select(part.alias("part")), "part")


@query("stratified_sample")
def stratified_sample(t: Tables) -> DataFrame:
    fractions = {"R": 1.0, "N": 0.1675}
    sampled = rows.stratified_sample(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag"),
        "l_returnflag",
        fractions,
        seed=123456,
    )
    return sampled


@query(
    "stratified_modulo_sample",
    """SELECT l_returnflag, count(*) AS n
       FROM lineitem
       WHERE l_returnflag = 'R' OR (l_returnflag = 'N' AND l_orderkey % 6 = 0)
       GROUP BY l_returnflag""",
)
def stratified_modulo_sample(t: Tables) -> DataFrame:
    kept = rows.stratified_step_sample(
        t.lineitem, "l_returnflag", {"R": 1, "N": 6}, F.col("l_orderkey")
    )
    return groups.count_by(kept, "l_returnflag")


@query("prefix_map", "SELECT c_custkey, 'hi,' || c_name AS greeting FROM customer")
def prefix_map(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.concat(F.lit("hi,"), F.col("c_name")).alias("greeting"))


@query(
    "head_ordered",
    """SELECT o_orderkey, o_totalprice FROM orders
       ORDER BY o_orderdate, o_orderkey LIMIT 5""",
)
def head_ordered(t: Tables) -> DataFrame:
    first = t.orders.orderBy("o_orderdate", "o_orderkey").limit(5)
    return first.select("o_orderkey", "o_totalprice")


@query(
    "union_all_train_test",
    """SELECT l_orderkey, l_quantity, l_tax FROM lineitem WHERE l_linestatus = 'F'
       UNION ALL
       SELECT l_orderkey, l_quantity, l_tax FROM lineitem WHERE l_linestatus IS DISTINCT FROM 'F'""",
)
def union_all_train_test(t: Tables) -> DataFrame:
    closed = F.col("l_linestatus").eqNullSafe("F")
    train = t.lineitem.where(closed).select(
        "l_orderkey", "l_quantity", "l_tax", F.col("l_extendedprice").alias("loss")
    )
    test = t.lineitem.where(~closed).select("l_tax", "l_quantity", "l_orderkey")
    return rows.union_rows(train, test, drop_left=["loss"])


# --- joins -------------------------------------------------------------------


@query(
    "join_multiplicity_count",
    """SELECT l_partkey AS key, count(*) AS n
       FROM lineitem JOIN orders ON l_partkey = o_custkey GROUP BY l_partkey""",
)
def join_multiplicity_count(t: Tables) -> DataFrame:
    left = t.lineitem.select(F.col("l_partkey").alias("key"))
    right = t.orders.select(F.col("o_custkey").alias("key"))
    return joins.join_multiplicity(left, right, "key")


@query(
    "semi_join_known_items",
    """SELECT p_partkey, p_name FROM part
       WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 50
                           AND l_returnflag = 'R')""",
)
def semi_join_known_items(t: Tables) -> DataFrame:
    wanted = t.lineitem.where((F.col("l_quantity") >= 50) & (F.col("l_returnflag") == "R"))
    known = wanted.select(F.col("l_partkey").alias("p_partkey"))
    return joins.keep_known(t.part.select("p_partkey", "p_name"), known, "p_partkey")


@query(
    "anti_join_unseen_items",
    """SELECT p_partkey, p_name FROM part
       WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 48)""",
)
def anti_join_unseen_items(t: Tables) -> DataFrame:
    seen = t.lineitem.where(F.col("l_quantity") >= 48)
    known = seen.select(F.col("l_partkey").alias("p_partkey"))
    return joins.drop_known(t.part.select("p_partkey", "p_name"), known, "p_partkey")


def part_aliases(t: Tables) -> DataFrame:
    """Every third part stands for the first part of its ten."""
    key = F.col("p_partkey")
    return t.part.where(key % 3 == 0).select(
        key.alias("item"), (key - key % 10).alias("alias")
    )


ALIAS_SQL = """SELECT p_partkey AS item, p_partkey - p_partkey % 10 AS alias
               FROM part WHERE p_partkey % 3 = 0"""


@query(
    "alias_broadcast_resolve",
    f"""SELECT l_orderkey, l_linenumber, coalesce(alias, l_partkey) AS item
        FROM lineitem LEFT JOIN ({ALIAS_SQL}) ON l_partkey = item""",
)
def alias_broadcast_resolve(t: Tables) -> DataFrame:
    plays = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("item"))
    return joins.resolve_alias(plays, "item", part_aliases(t), "item", "alias")


@query(
    "positional_zip",
    """WITH a AS (SELECT p_partkey AS by_key, row_number() OVER (ORDER BY p_partkey) - 1 AS idx
                  FROM part),
            b AS (SELECT p_partkey AS by_name,
                         row_number() OVER (ORDER BY p_name, p_partkey) - 1 AS idx FROM part),
            c AS (SELECT p_partkey AS by_price,
                         row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) - 1 AS idx
                  FROM part)
       SELECT idx, by_key, by_name, by_price FROM a JOIN b USING (idx) JOIN c USING (idx)""",
)
def positional_zip(t: Tables) -> DataFrame:
    def keyed(name: str) -> DataFrame:
        return t.part.withColumn(name, F.col("p_partkey"))

    return joins.zip_rows(
        by_key=(keyed("by_key"), ["p_partkey"]),
        by_name=(keyed("by_name"), ["p_name", "p_partkey"]),
        by_price=(keyed("by_price"), [F.desc("p_retailprice"), "p_partkey"]),
    )


# --- groups ------------------------------------------------------------------

MEMBER_ORDERS_SQL = """SELECT n_name AS area, o_orderstatus AS goods, c_mktsegment AS member,
                              o_orderpriority AS product, o_totalprice AS price
                       FROM orders JOIN customer ON o_custkey = c_custkey
                       JOIN nation ON c_nationkey = n_nationkey"""


def member_orders(t: Tables) -> DataFrame:
    """Orders with the buyer's country and segment."""
    buyers = t.customer.join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    ).select(F.col("c_custkey").alias("o_custkey"), "n_name", "c_mktsegment")
    return t.orders.join(buyers, "o_custkey").select(
        F.col("n_name").alias("area"),
        F.col("o_orderstatus").alias("goods"),
        F.col("c_mktsegment").alias("member"),
        F.col("o_orderpriority").alias("product"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
    )


def _as_double(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.withColumns({c: F.col(c).cast("double") for c in columns})


@query(
    "group_sum_three_keys",
    f"""SELECT area, member, product, CAST(sum(CAST(price AS DECIMAL(18, 2))) AS DOUBLE) AS total
        FROM ({MEMBER_ORDERS_SQL}) GROUP BY area, member, product""",
)
def group_sum_three_keys(t: Tables) -> DataFrame:
    sums = groups.sum_by(member_orders(t), ["area", "member", "product"], {"total": "price"})
    return _as_double(sums, "total")


@query(
    "grouping_sets_mixed",
    f"""SELECT area, goods, member, product,
               CAST(grouping(area, goods, member, product) AS BIGINT) AS grouping_id,
               CAST(sum(CAST(price AS DECIMAL(18, 2))) AS DOUBLE) AS total
        FROM ({MEMBER_ORDERS_SQL})
        GROUP BY GROUPING SETS ((area), (goods), (member, product),
                                (area, member, product, goods))
        ORDER BY area, member, product, goods""",
)
def grouping_sets_mixed(t: Tables) -> DataFrame:
    sets = [["area"], ["goods"], ["member", "product"], ["area", "member", "product", "goods"]]
    out = groups.grouping_sets(member_orders(t), sets, {"total": "price"})
    return _as_double(out, "total").orderBy("area", "member", "product", "goods")


@query(
    "sql_view_grouping_sets",
    f"""SELECT area, goods, CAST(sum(price_cents) AS BIGINT) AS cents,
               CAST(grouping(area, goods) AS BIGINT) AS grouping_id
        FROM (SELECT *, CAST(round(price * 100) AS BIGINT) AS price_cents
              FROM ({MEMBER_ORDERS_SQL}))
        GROUP BY GROUPING SETS ((area), (area, goods), (goods))""",
)
def sql_view_grouping_sets(t: Tables) -> DataFrame:
    """The same kind of query as SQL text over a temporary view."""
    member_orders(t).createOrReplaceTempView("member_orders")
    return t.spark.sql(
        """SELECT area, goods, sum(cast(price * 100 AS bigint)) AS cents,
                  grouping_id(area, goods) AS grouping_id
           FROM member_orders
           GROUP BY area, goods GROUPING SETS ((area), (area, goods), (goods))"""
    )


@query(
    "grouping_sets_single",
    f"""SELECT area, member, product,
               CAST(grouping(area, member, product) AS BIGINT) AS grouping_id,
               CAST(sum(CAST(price AS DECIMAL(18, 2))) AS DOUBLE) AS total
        FROM ({MEMBER_ORDERS_SQL})
        GROUP BY GROUPING SETS ((area), (member), (product))""",
)
def grouping_sets_single(t: Tables) -> DataFrame:
    sets = [["area"], ["member"], ["product"]]
    return _as_double(groups.grouping_sets(member_orders(t), sets, {"total": "price"}), "total")


@query(
    "group_count_ranked",
    """SELECT event_type, count(*) AS n FROM events
       GROUP BY event_type ORDER BY n DESC, event_type""",
)
def group_count_ranked(t: Tables) -> DataFrame:
    return groups.count_by(t.events, "event_type").orderBy(F.desc("n"), "event_type")


@query(
    "two_key_count",
    """SELECT user_id, event_type, count(*) AS n FROM events
       GROUP BY user_id, event_type ORDER BY user_id, n DESC, event_type""",
)
def two_key_count(t: Tables) -> DataFrame:
    return groups.count_by(t.events, "user_id", "event_type").orderBy(
        "user_id", F.desc("n"), "event_type"
    )


@query(
    "group_sum_shortcut",
    """SELECT l_returnflag, CAST(sum(l_linenumber) AS BIGINT) AS n_lines
       FROM lineitem GROUP BY l_returnflag""",
)
def group_sum_shortcut(t: Tables) -> DataFrame:
    summed = t.lineitem.groupBy("l_returnflag").sum("l_linenumber")
    return summed.withColumnRenamed("sum(l_linenumber)", "n_lines")


@query(
    "class_total_measures",
    """WITH s AS (SELECT l_returnflag,
                         sum(CAST(l_quantity AS DECIMAL(18, 2))) AS q,
                         sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS p,
                         sum(CAST(l_tax AS DECIMAL(18, 2))) AS x
                  FROM lineitem GROUP BY l_returnflag)
       SELECT l_returnflag, CAST(q AS DOUBLE) AS quantity, CAST(p AS DOUBLE) AS price,
              CAST(x AS DOUBLE) AS tax, CAST(q + p + x AS DOUBLE) AS total
       FROM s ORDER BY total DESC, l_returnflag""",
)
def class_total_measures(t: Tables) -> DataFrame:
    measures = {"quantity": "l_quantity", "price": "l_extendedprice", "tax": "l_tax"}
    amounts = {c: F.col(c).cast("decimal(18,2)") for c in measures.values()}
    lines = t.lineitem.select("l_returnflag", *[e.alias(c) for c, e in amounts.items()])
    return _as_double(groups.class_totals(lines, "l_returnflag", measures), *measures, "total")


@query(
    "conditional_ratio",
    """SELECT l_suppkey, count(*) AS total,
              count(*) FILTER (WHERE l_discount > l_tax) AS correct,
              count(*) FILTER (WHERE l_discount > l_tax) / count(*) AS ratio
       FROM lineitem GROUP BY l_suppkey""",
)
def conditional_ratio(t: Tables) -> DataFrame:
    return groups.share_where(t.lineitem, ["l_suppkey"], F.col("l_discount") > F.col("l_tax"))


@query(
    "conditional_ratio_mean",
    """SELECT round(avg(r), 9) AS mean_ratio
       FROM (SELECT count(*) FILTER (WHERE l_discount > l_tax) / count(*) AS r
             FROM lineitem GROUP BY l_suppkey)""",
)
def conditional_ratio_mean(t: Tables) -> DataFrame:
    return conditional_ratio(t).agg(F.round(F.avg("ratio"), 9).alias("mean_ratio"))


@query(
    "set_concat_per_group",
    """SELECT user_id, part, string_agg(event_type, ',' ORDER BY event_type) AS event_types
       FROM (SELECT user_id, event_type,
                    (row_number() OVER (PARTITION BY user_id ORDER BY event_type) - 1) // 50 AS part
             FROM (SELECT DISTINCT user_id, event_type FROM events))
       GROUP BY user_id, part""",
)
def set_concat_per_group(t: Tables) -> DataFrame:
    """A user's kinds of events as text, fifty to a row."""
    kinds = pairs.distinct_values(t.events, "user_id", "event_type")
    return pairs.joined_text(kinds, "user_id", "event_type", ",", size=50, name="event_types")


@query(
    "pivot_count_matrix",
    """SELECT o_orderpriority,
              count(*) FILTER (WHERE o_orderstatus = 'F') AS "F",
              count(*) FILTER (WHERE o_orderstatus = 'O') AS "O",
              count(*) FILTER (WHERE o_orderstatus = 'P') AS "P"
       FROM orders GROUP BY o_orderpriority ORDER BY o_orderpriority""",
)
def pivot_count_matrix(t: Tables) -> DataFrame:
    return groups.pivot_counts(t.orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


PROFILED = {
    "l_quantity": True,
    "l_extendedprice": True,
    "l_linenumber": True,
    "l_returnflag": False,
    "l_linestatus": False,
}


def _profile_sql() -> str:
    parts = []
    for name, numeric in PROFILED.items():
        number = f"CAST({name} AS DOUBLE)" if numeric else "CAST(NULL AS DOUBLE)"
        text = "CAST(NULL AS VARCHAR)" if numeric else name
        parts.append(
            f"""SELECT '{name}' AS "column", count({name}) AS "count",
                       round(avg({number}), 6) AS mean, round(stddev_samp({number}), 6) AS stddev,
                       min({number}) AS "min", max({number}) AS "max",
                       min({text}) AS min_text, max({text}) AS max_text FROM lineitem"""
        )
    return " UNION ALL ".join(parts)


@query("column_profile", _profile_sql())
def column_profile(t: Tables) -> DataFrame:
    found = groups.column_profile(t.lineitem, list(PROFILED))
    return found.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@query("distinct_items", "SELECT DISTINCT l_partkey FROM lineitem")
def distinct_items(t: Tables) -> DataFrame:
    return t.lineitem.select("l_partkey").distinct()


@query(
    "class_priors",
    """SELECT o_orderstatus, count(*) AS n, count(*) / (SELECT count(*) FROM orders) AS share
       FROM orders GROUP BY o_orderstatus ORDER BY o_orderstatus""",
)
def class_priors(t: Tables) -> DataFrame:
    return groups.class_shares(t.orders, "o_orderstatus").orderBy("o_orderstatus")


@query(
    "weighted_group_entropy",
    """WITH c AS (SELECT o_orderpriority AS g, o_orderstatus AS l, count(*) AS n
                  FROM orders GROUP BY ALL),
            s AS (SELECT g, sum(n) AS size FROM c GROUP BY g),
            e AS (SELECT c.g, size, -sum(n / size * ln(n / size)) AS h
                  FROM c JOIN s USING (g) GROUP BY c.g, size)
       SELECT round(sum(size * h) / sum(size), 9) AS entropy FROM e""",
)
def weighted_group_entropy(t: Tables) -> DataFrame:
    found = groups.weighted_entropy(t.orders, "o_orderpriority", "o_orderstatus")
    return found.select(F.round("entropy", 9).alias("entropy"))


# --- windows and rankings ------------------------------------------------------

GAPPY_SQL = """SELECT event_id, user_id, ts,
                      CASE WHEN event_type IN ('view', 'click') THEN NULL ELSE value END AS value
               FROM events"""
SO_FAR_SQL = """(PARTITION BY user_id ORDER BY ts, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


def _gappy_events(t: Tables) -> DataFrame:
    value = F.when(~F.col("event_type").isin("view", "click"), F.col("value"))
    return t.events.select("event_id", "user_id", "ts", value.alias("value"))


@query(
    "first_last_non_null",
    f"""SELECT event_id, user_id, first_value(value IGNORE NULLS) OVER {SO_FAR_SQL} AS first_val,
               last_value(value IGNORE NULLS) OVER {SO_FAR_SQL} AS last_val
        FROM ({GAPPY_SQL})""",
)
def first_last_non_null(t: Tables) -> DataFrame:
    found = windows.first_last_non_null(
        _gappy_events(t), ["user_id"], ["ts", "event_id"], "value"
    )
    return found.select("event_id", "user_id", "first_val", "last_val")


@query(
    "forward_fill",
    f"""SELECT event_id, user_id, last_value(value IGNORE NULLS) OVER {SO_FAR_SQL} AS value
        FROM ({GAPPY_SQL})""",
)
def forward_fill(t: Tables) -> DataFrame:
    filled = windows.forward_fill(_gappy_events(t), ["user_id"], ["ts", "event_id"], "value")
    return filled.select("event_id", "user_id", "value")


@query(
    "top_n_by_score",
    """SELECT o_orderkey, o_totalprice FROM orders
       ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
)
def top_n_by_score(t: Tables) -> DataFrame:
    scored = t.orders.select("o_orderkey", "o_totalprice")
    return ranking.top_n(scored, "o_totalprice", 10, ["o_orderkey"])


@query(
    "nth_largest_threshold",
    """SELECT min(l_extendedprice) AS threshold
       FROM (SELECT l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC LIMIT 100)""",
)
def nth_largest_threshold(t: Tables) -> DataFrame:
    return ranking.nth_largest(t.lineitem, "l_extendedprice", 100)


@query(
    "at_least_nth_largest",
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
       WHERE l_extendedprice >= (
         SELECT min(p) FROM (SELECT l_extendedprice AS p FROM lineitem ORDER BY p DESC LIMIT 100))
    """,
)
def at_least_nth_largest(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return ranking.at_least_nth_largest(lines, "l_extendedprice", 100)

"""URL filter: rules first, then the ratio of two character language models.

DataFrame operations only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywood.plans.scratch import materialized

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# 32 symbols: a-z, 0 for any digit, . / -, ~ for all others, ^ before and after a URL.
SYMBOLS = 32
# Symbols before the one that is predicted. With 32 symbols there are at most
# 32^(ORDER + 1), about a million, different grams, whatever the number of URLs.
ORDER = 3
# Log ratios are counted in millionths, thresholds in hundredths.
UNIT, BIN = 1_000_000, 10_000.0

Rule = tuple[str, str]


def host_of(url: str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), "://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: str) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), "://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule (verdict, ``host/path``) that fits, as struct(rule, verdict)."""
    chosen = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        own, slash, rest = rule.partition("/")
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(slash + rest)
        chosen = F.when(
            fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        ).otherwise(chosen)
    return chosen


def symbols(url: str) -> Column:
    """A URL without its scheme in the 32 symbols, between start and end marks."""
    whole = F.coalesce(F.col(url), F.lit(""))
    rest = F.when(F.instr(whole, "://") > 0, F.regexp_replace(whole, "(?s)^.*?://", "")).otherwise(whole)
    lower = F.translate(rest, UPPER, LOWER)
    few = F.regexp_replace(F.regexp_replace(lower, "[0-9]", "0"), "[^a-z0./-]", "~")
    return F.concat(F.lit("^" * ORDER), few, F.lit("^"))


def grams(rows: DataFrame, text: str) -> DataFrame:
    """One row for each symbol with the ORDER symbols before it, as ``gram``."""
    last = F.length(text) - ORDER
    return rows.withColumn("at", F.explode(F.sequence(F.lit(1), last))).select(
        *[c for c in rows.columns if c != text],
        F.col(text).substr(F.col("at"), F.lit(ORDER + 1)).alias("gram"),
    )


def gram_weights(counts: DataFrame) -> DataFrame:
    """(gram, weight): log of its probability as accepted over that as rejected.

    ``counts``: gram, accepted, rejected, over all grams that may be asked for. Both
    models interpolate all orders by Witten and Bell: a context that was followed by
    many different symbols trusts the shorter context more, and one never seen takes
    the shorter context's probability, so the order varies with the data.
    """
    below = None
    for order in range(ORDER + 1):
        tail = F.col("gram").substr(ORDER + 1 - order, order + 1)
        level = counts.groupBy(tail.alias("tail")).agg(
            F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected")
        )
        # Order 0 has one context; its table has at most 32 rows.
        context = Window.partitionBy(F.col("tail").substr(1, order))
        stats = [F.col("tail")]
        for kind in ("accepted", "rejected"):
            stats += [
                F.col(kind).cast("double").alias(kind),
                F.sum(kind).over(context).cast("double").alias(f"{kind}_all"),
                F.sum((F.col(kind) > 0).cast("int")).over(context).cast("double").alias(f"{kind}_kinds"),
            ]
        level = level.select(*stats)
        if below is None:
            level = level.withColumns({f"{k}_p": F.lit(1.0 / SYMBOLS) for k in ("accepted", "rejected")})
        else:
            level = level.withColumn("shorter", F.substring("tail", 2, order)).join(below, "shorter")
        p = {
            f"{k}_p": F.when(
                F.col(f"{k}_all") + F.col(f"{k}_kinds") > 0,
                (F.col(k) + F.col(f"{k}_kinds") * F.col(f"{k}_p"))
                / (F.col(f"{k}_all") + F.col(f"{k}_kinds")),
            ).otherwise(F.col(f"{k}_p"))
            for k in ("accepted", "rejected")
        }
        below = level.select(F.col("tail").alias("shorter"), *[c.alias(k) for k, c in p.items()])
    ratio = (F.log("accepted_p") - F.log("rejected_p")) * UNIT
    return below.select(F.col("shorter").alias("gram"), F.round(ratio).cast("bigint").alias("weight"))


def _calibrated(scored: DataFrame) -> int:
    """The bin that best splits accepted from rejected rows, by balanced accuracy.

    The cut lies in the middle between two bins with rows. Among equals the one with
    the widest gap, then the one nearest to zero, then the smaller. Zero without rows of
    both kinds. The rows are summed up by bin first; log ratios lie within about 20,
    so there are some thousand bins however many rows.
    """
    bins = scored.groupBy("bin").agg(
        F.sum((F.col("known") == "allow").cast("bigint")).alias("a"),
        F.sum((F.col("known") == "block").cast("bigint")).alias("r"),
    )
    upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    before = F.lag("bin").over(Window.orderBy("bin"))
    every = Window.partitionBy()
    kept = F.sum("a").over(every) - F.coalesce(F.sum("a").over(upto), F.lit(0))
    gone = F.coalesce(F.sum("r").over(upto), F.lit(0))
    ranked = bins.select(
        F.coalesce(F.floor((before + F.col("bin") + 1) / 2), "bin").alias("cut"),
        (F.col("bin") - before).alias("gap"), kept.alias("kept"), gone.alias("gone"),
        F.sum("a").over(every).alias("all_a"), F.sum("r").over(every).alias("all_r"),
    ).where("all_a > 0 AND all_r > 0")
    share = F.col("kept") / F.col("all_a") + F.col("gone") / F.col("all_r")
    order = (F.desc(share), F.desc_nulls_last("gap"), F.abs("cut"), "cut")
    best = ranked.orderBy(*order).select("cut").first()
    return best["cut"] if best else 0


def judge(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(page_id, host, path, rule, verdict, margin) of every row of ``pages`` (page_id, url).

    A row that a rule fits takes the longest rule's verdict. The others are judged by
    two character models, learnt from the URLs of rules that allow and of rules that
    block: allowed if the log-likelihood ratio per symbol reaches the threshold that
    separates the two kinds best on a quarter of the ruled URLs kept from learning.
    ``margin`` is that ratio less the threshold in hundredths, also of ruled rows.

    URLs become at most a million different grams, so the weights have a bounded size
    and are broadcast; counts and sums are aggregated before they are shuffled, so a
    host or gram with any share of the rows costs no more.

    Null url, or one without ``://``: host and path empty; it is judged by the models
    like any other. Null ids and repeated rows come out as they came; without ruled
    URLs of both kinds every other row is allowed; no rows give no rows.
    """
    host, path = host_of("url"), path_of("url")
    held_back = F.substring(F.md5(F.coalesce(F.col("url"), F.lit("")).cast("binary")), 1, 1).isin(*"0123")
    prepared = materialized(
        pages.select(
            F.monotonically_increasing_id().alias("row"), F.col("page_id"),
            host.alias("host"), path.alias("path"), symbols("url").alias("text"),
            rule_of(host, path, rules).alias("ruled"), held_back.alias("held_back"),
        ),
        "urls",
    )
    known = F.when(~F.col("held_back"), F.col("ruled.verdict"))
    counts = grams(prepared.select(known.alias("known"), "text"), "text").groupBy("gram").agg(
        F.sum((F.col("known").eqNullSafe("allow")).cast("bigint")).alias("accepted"),
        F.sum((F.col("known").eqNullSafe("block")).cast("bigint")).alias("rejected"),
    )
    weights = materialized(gram_weights(materialized(counts, "grams")), "weights")
    sums = (
        grams(prepared.select("row", "text"), "text")
        .join(F.broadcast(weights), "gram")
        .groupBy("row")
        .agg(F.sum("weight").alias("total"), F.count(F.lit(1)).alias("n"))
    )
    bin_of = F.floor(F.col("total").cast("double") / (F.col("n") * BIN))
    scored = materialized(
        prepared.drop("text").join(sums.select("row", bin_of.alias("bin")), "row"), "scored"
    )
    threshold = _calibrated(
        scored.where("held_back AND ruled IS NOT NULL").select("bin", F.col("ruled.verdict").alias("known"))
    )
    margin = F.col("bin") - threshold
    by_model = F.when(margin >= 0, "allow").otherwise("block")
    return scored.select(
        "page_id", "host", "path", F.col("ruled.rule").alias("rule"),
        F.coalesce(F.col("ruled.verdict"), by_model).alias("verdict"),
        margin.cast("bigint").alias("margin"),
    )


def judge_sql(rules: Sequence[Rule]) -> str:
    """The same as one SQL statement over the table ``pages``."""
    ordered = sorted(rules, key=lambda r: -len(r[1]))

    def fits(rule: str) -> str:
        own, slash, rest = rule.partition("/")
        return f"(host = '{own}' OR ends_with(host, '.{own}')) AND starts_with(path, '{slash}{rest}')"

    def pick(value) -> str:
        cases = " ".join(f"WHEN {fits(r)} THEN '{value(v, r)}'" for v, r in ordered)
        return f"CASE {cases} END"

    levels = []
    for k in range(ORDER + 1):
        shorter = "" if not k else f"JOIN l{k - 1} b ON b.tail = substr(s.tail, 2)"
        p = {}
        for c in "ar":
            low = f"b.p{c}" if k else f"(1.0::DOUBLE / {SYMBOLS})"
            p[c] = (
                f"CASE WHEN {c}_all + {c}_kinds > 0 THEN ({c} + {c}_kinds * {low}) / "
                f"({c}_all + {c}_kinds) ELSE {low} END AS p{c}"
            )
        stats = ", ".join(
            f"s0.{c}::DOUBLE AS {c}, (sum(s0.{c}) OVER w)::DOUBLE AS {c}_all, "
            f"(sum((s0.{c} > 0)::INT) OVER w)::DOUBLE AS {c}_kinds"
            for c in "ar"
        )
        levels.append(
            f"l{k} AS (SELECT s.tail, {p['a']}, {p['r']} FROM (SELECT tail, {stats} FROM "
            f"(SELECT substr(gram, {ORDER + 1 - k}, {k + 1}) AS tail, sum(a) AS a, sum(r) AS r "
            f"FROM counts GROUP BY 1) s0 WINDOW w AS (PARTITION BY substr(tail, 1, {k}))) s {shorter})"
        )
    return rf"""
    WITH parts AS (
      SELECT row_number() OVER () AS row, page_id, coalesce(url, '') AS u,
        translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
        regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
      FROM pages
    ),
    urls AS (
      SELECT row, page_id, host, path, {pick(lambda v, r: r)} AS rule, {pick(lambda v, r: v)} AS ruled,
        substr(md5(u), 1, 1) IN ('0', '1', '2', '3') AS held_back,
        '{"^" * ORDER}' || regexp_replace(regexp_replace(translate(
          CASE WHEN contains(u, '://') THEN substr(u, instr(u, '://') + 3) ELSE u END,
          '{UPPER}', '{LOWER}'), '[0-9]', '0', 'g'), '[^a-z0./-]', '~', 'g') || '^' AS text
      FROM parts
    ),
    places AS (
      SELECT row, ruled, held_back, text, unnest(range(1, length(text) - {ORDER} + 1)) AS i FROM urls
    ),
    grams AS (SELECT row, ruled, held_back, substr(text, i, {ORDER + 1}) AS gram FROM places),
    counts AS (
      SELECT gram, count(*) FILTER (WHERE ruled = 'allow' AND NOT held_back) AS a,
        count(*) FILTER (WHERE ruled = 'block' AND NOT held_back) AS r
      FROM grams GROUP BY gram
    ),
    {", ".join(levels)},
    weights AS (
      SELECT tail AS gram, CAST(round((ln(pa) - ln(pr)) * {UNIT}) AS BIGINT) AS weight FROM l{ORDER}
    ),
    sums AS (
      SELECT row, CAST(floor(CAST(sum(weight) AS DOUBLE) / (count(*) * {BIN}::DOUBLE)) AS BIGINT) AS bin
      FROM grams JOIN weights USING (gram) GROUP BY row
    ),
    bins AS (
      SELECT bin, count(*) FILTER (WHERE ruled = 'allow') AS a, count(*) FILTER (WHERE ruled = 'block') AS r
      FROM urls JOIN sums USING (row) WHERE held_back AND ruled IS NOT NULL GROUP BY bin
    ),
    cuts AS (
      SELECT CAST(coalesce(floor((lag(bin) OVER (ORDER BY bin) + bin + 1) / 2.0), bin) AS BIGINT) AS cut,
        bin - lag(bin) OVER (ORDER BY bin) AS gap, (sum(a) OVER () - coalesce(sum(a) OVER u, 0))::DOUBLE / (sum(a) OVER ())
        + coalesce(sum(r) OVER u, 0)::DOUBLE / (sum(r) OVER ()) AS share,
        sum(a) OVER () AS all_a, sum(r) OVER () AS all_r
      FROM bins WINDOW u AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ),
    chosen AS (
      SELECT coalesce((SELECT cut FROM cuts WHERE all_a > 0 AND all_r > 0
        ORDER BY share DESC, gap DESC NULLS LAST, abs(cut), cut LIMIT 1), 0) AS threshold
    )
    SELECT page_id, host, path, rule,
      coalesce(ruled, CASE WHEN bin >= threshold THEN 'allow' ELSE 'block' END) AS verdict,
      CAST(bin - threshold AS BIGINT) AS margin
    FROM urls JOIN sums USING (row), chosen
    """


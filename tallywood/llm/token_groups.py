"""Documents with similar sets of word shingles, joined through a token-group matrix.

Similar documents are put into groups; the matrix says which tokens (shingles) some
member of a group holds. What a document shares with a group's tokens bounds what it can
share with any member, so only groups that reach the needed overlap are opened and
their members compared: first by sketches of a bit or two a token, which bound from below
in how many tokens two sets differ, then, where these leave it open, by the tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywood.llm.components import connected_components
from tallywood.llm.frames import texts_of
from tallywood.plans.scratch import materialized

# Documents whose tokens are counted to tell frequent ones (so many, or that share of all if
# it is more), and from how many of them a token is. They are compared last, which steers the
# work; no result depends on it. All tokens of such a document count: one of a family that
# differs in enough tokens of its own then has no prefix token in common with the others.
SAMPLE_DOCS, SAMPLE_SHARE, FREQUENT, MOST_FREQUENT = 8000, 1 / 8, 4, 200_000
# Bits that tell, by a hash of the id, which documents' texts are not needed: 1 MB.
TEXT_BITS = 1 << 23
# Tokens of the members of a group, and of the queries that meet it in one task, about.
GROUP_TOKENS, QUERY_TOKENS = 100_000, 500_000


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; a bijection."""
    # Multipliers of the splitmix64 finalizer.
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Ascending 64-bit hashes of the distinct shingles of a UTF-8 text.

    A-Z are lower-cased, words end at ASCII white space. A shingle is ``words``
    successive words; a text of fewer is one shingle, one without words has none.
    """
    parts = text.lower().split()
    if not parts:
        return np.zeros(0, dtype=np.int64)
    width = min(words, len(parts))
    digest = xxhash.xxh3_64_intdigest
    each = np.array([digest(p) for p in parts], dtype=np.uint64)
    total = len(parts) - width + 1
    hashed = np.full(total, width, dtype=np.uint64)
    for i in range(width):
        hashed = _mixed(hashed * np.uint64(0x9E3779B97F4A7C15) + each[i : i + total])
    return np.unique(hashed.view(np.int64))


def _prefix(tokens: np.ndarray, percent: int, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first tokens in the common order: rare ones by hash, then frequent ones by rank.

    So many that a set of the needed similarity must hold one of them in its own prefix.
    """
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        often = frequent[at] == tokens
        last = tokens[often][np.argsort(rank[at[often]])]
        tokens = np.concatenate([tokens[~often], last])
    n = len(tokens)
    return tokens[: n + (-percent * n) // 100 + 1]


def _frequent(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending tokens that many documents of a sample hold, and their rank by count."""
    share = max(SAMPLE_SHARE, SAMPLE_DOCS / max(docs.count(), 1))
    sample = docs.select("text").sample(False, min(1.0, share), seed=7)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in texts_of(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(text, words))], ["token"])

    counts = sample.mapInArrow(run, "token bigint").groupBy("token").count()
    top = counts.where(F.col("count") >= FREQUENT).orderBy(F.desc("count"), "token").limit(MOST_FREQUENT)
    found = sorted((r["count"], r["token"]) for r in top.collect())
    tokens = np.array([t for _, t in found], dtype=np.int64)
    order = np.argsort(tokens)
    return tokens[order], order


def _class_id(tokens: np.ndarray) -> int:
    """64-bit hash of a set: equal sets are one class."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).view(np.int64))


def set_sketch(tokens: np.ndarray) -> bytes:
    """For each of 64 bits or more, a power of two and at least as many as tokens, whether
    an odd number of tokens fall to it.

    A token that only one of two sets holds changes one bit, so the sketches differ in no
    more bits than the sets in tokens.
    """
    width = max(64, 1 << (len(tokens) - 1).bit_length())
    odd = np.bincount(tokens & (width - 1), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _digests(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, cid, n, like, sketch, prefix) of every row: the class and the size of its set,
    a second smallest hash, its sketch and its first tokens; without words all but n are null.

    ``like`` is equal for two sets as likely as they are similar. Copies that meet in one
    task have one prefix between them.
    """
    frequent, rank = _frequent(docs, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            rows: list[tuple] = []
            for text in texts_of(batch.column("text")):
                tokens = shingle_set(text, words)
                if not len(tokens):
                    rows.append((None, 0, None, None, None))
                    continue
                second = _mixed(tokens.view(np.uint64) ^ np.uint64(words)).min()
                cid = _class_id(tokens)
                rows.append((
                    cid, len(tokens), int(second.view(np.int64)), set_sketch(tokens),
                    None if cid in seen else _prefix(tokens, percent, frequent, rank),
                ))
                seen.add(cid)
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["doc_id", "cid", "n", "like", "sketch", "prefix"],
            )

    return docs.mapInArrow(
        run, "doc_id bigint, cid bigint, n bigint, like bigint, sketch binary, prefix array<bigint>"
    )


def _perhaps_in(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is in ``ids`` (w), and few others."""
    # Spark's bitmaps have 32768 bits.
    place = [F.pmod(F.xxhash64(c), F.lit(TEXT_BITS)) for c in ("w", "doc_id")]
    block, bit = ([f(p).cast("int") for p in place] for f in (lambda p: p / 32768, lambda p: p % 32768))
    bits = ids.groupBy(block[0].alias("block")).agg(F.bitmap_construct_agg(bit[0].cast("bigint")).alias("bits"))
    byte = F.conv(F.hex(F.substring("bits", (bit[1] / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = docs.withColumn("block", block[1]).join(F.broadcast(bits), "block")
    return found.where(F.getbit(byte, bit[1] % 8) == 1).select("doc_id", "text")


def _texts(docs: DataFrame, classes: DataFrame, needed: DataFrame) -> DataFrame:
    """(cid, text) of the classes in ``needed`` (cid), by the document that stands for each.

    Texts travel instead of tokens, as they are smaller. Where an id has several texts all
    are there; ``_with_tokens`` takes the right one. A bitmap of fixed size keeps most other
    texts from being shuffled for the join with a long list.
    """
    wanted = materialized(
        classes.join(needed.distinct(), "cid", "left_semi").select("cid", F.col("doc_id").alias("w")), "wanted"
    )
    near = _perhaps_in(docs, wanted.select("w"))
    texts = materialized(
        near.join(wanted, near["doc_id"].eqNullSafe(wanted["w"])).select("cid", "text"), "texts"
    )
    repeated = texts.groupBy("cid").count().where("count > 1")
    return texts if repeated.isEmpty() else materialized(texts.distinct(), "texts")


def _with_tokens(rows: pa.Table, words: int) -> pa.Table:
    """Rows with the tokens of their text, without those of another text of the same id."""
    rows = rows.combine_chunks()
    sets, kept = [], []
    texts = (t for chunk in rows.column("text").chunks for t in texts_of(chunk))
    for at, (cid, text) in enumerate(zip(rows.column("cid").to_pylist(), texts)):
        tokens = shingle_set(text, words)
        if len(tokens) and _class_id(tokens) == cid:
            sets.append(tokens)
            kept.append(at)
    taken = rows.drop_columns(["text"]).take(pa.array(kept, pa.int64()))
    return taken.append_column("tokens", pa.array(sets, pa.list_(pa.int64())))


def _reach(percent: int, n: Column, pos: Column) -> Column:
    """``percent`` times the size of the largest set that may be similar to one of ``n`` tokens
    when their common tokens begin at place ``pos`` or later of its order."""
    return 100 * n.cast("bigint") - (100 + percent) * pos


def _lists(table: pa.Table) -> list[np.ndarray]:
    column = table.column("tokens").combine_chunks()
    flat = column.values.to_numpy(zero_copy_only=False)
    offsets = column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(offsets, offsets[1:])]


def open_group(queries: pa.Table, members: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Links between queries and members of one group, as many as join their components.

    A query whose overlap with the union of the members' tokens is too small for any
    member is done with; for the others the common tokens with each member are counted.
    """
    if not queries.num_rows or not members.num_rows:
        return []
    own = _lists(members)
    sizes = np.array([len(s) for s in own])
    every, holder = np.concatenate(own), np.repeat(np.arange(len(own)), sizes)
    order = np.argsort(every, kind="stable")
    every, holder = every[order], holder[order]
    union = every[np.concatenate([[True], every[1:] != every[:-1]])]
    ids, parts = (members.column(c).to_pylist() for c in ("cid", "comp"))
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    links = []
    for cid, comp, tokens in zip(
        queries.column("cid").to_pylist(), queries.column("comp").to_pylist(), _lists(queries)
    ):
        at = np.minimum(np.searchsorted(union, tokens), len(union) - 1)
        if 100 * int((union[at] == tokens).sum()) < percent * len(tokens):
            continue
        low, high = np.searchsorted(every, tokens, "left"), np.searchsorted(every, tokens, "right")
        count = high - low
        shift = np.repeat(low - np.concatenate([[0], count.cumsum()[:-1]]), count)
        common = np.bincount(holder[np.arange(count.sum()) + shift], minlength=len(own))
        for i in np.flatnonzero((100 + percent) * common >= percent * (len(tokens) + sizes)).tolist():
            a, b = find(comp), find(parts[i])
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((cid, ids[i]))
    return links


def sift_group(queries: pa.Table, members: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Which queries and which members of one group (comp, n, sketch) may be similar to one on
    the other side that is of another component, by size and sketch."""
    left, right = ((t.column("comp").to_numpy(), t.column("n").to_numpy()) for t in (queries, members))
    kept = np.zeros(len(left[0]), dtype=bool), np.zeros(len(right[0]), dtype=bool)
    blocks: dict[int, list] = {}
    for i, sketch in enumerate(members.column("sketch").to_pylist()):
        blocks.setdefault(len(sketch), []).append((i, np.frombuffer(sketch, np.uint8)))
    stacked = {w: (np.array([i for i, _ in b]), np.stack([x for _, x in b])) for w, b in blocks.items()}
    folded: dict[tuple[int, int], np.ndarray] = {}
    for i, sketch in enumerate(queries.column("sketch").to_pylist()):
        own = np.frombuffer(sketch, np.uint8)
        for width, (at, theirs) in stacked.items():
            both = left[1][i] + right[1][at]
            fits = (100 + percent) * np.abs(left[1][i] - right[1][at]) <= (100 - percent) * both
            if not (fits & (right[0][at] != left[0][i])).any():
                continue
            # Halves of the longer sketch are added up, until both are of a length.
            least = min(width, len(own))
            if (width, least) not in folded:
                folded[width, least] = np.bitwise_xor.reduce(theirs.reshape(len(at), -1, least), axis=1)
            ours = np.bitwise_xor.reduce(own.reshape(-1, least), axis=0)
            differ = np.bitwise_count(folded[width, least] ^ ours).sum(axis=1, dtype=np.int64)
            good = fits & (right[0][at] != left[0][i]) & ((100 + percent) * differ <= (100 - percent) * both)
            kept[0][i] |= good.any()
            kept[1][at[good]] = True
    return kept


def _sifted(asked: DataFrame, opened: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(asks, gid, chunk, cid, comp): the queries, with ``asks``, and members that are left."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        for asks, table, kept in zip((True, False), (left, right), sift_group(left, right, percent)):
            rows = table.select(["gid", "chunk", "cid", "comp"]).filter(pa.array(kept))
            parts.append(rows.add_column(0, "asks", pa.array([asks] * rows.num_rows, pa.bool_())))
        return pa.concat_tables(parts)

    # Fresh columns by ``toDF``: both sides stem from the same tables.
    left, right = (
        f.join(classes, "cid").select("gid", "chunk", "cid", "comp", "n", "sketch")
        .toDF("gid", "chunk", "cid", "comp", "n", "sketch").groupBy("gid", "chunk")
        for f in (asked, opened)
    )
    found = left.cogroup(right).applyInArrow(
        run, "asks boolean, gid bigint, chunk bigint, cid bigint, comp bigint"
    )
    return materialized(found, "sifted")


def _opened(
    queries: DataFrame, members: DataFrame, docs: DataFrame, classes: DataFrame, words: int, percent: int
) -> DataFrame:
    """(a, b): verified links of ``queries`` (cid, comp, gid) with ``members`` (gid, cid, comp).

    Only groups that some query asks for are read. Many queries of one group are dealt to
    several tasks, each with the group's members. Texts are read of those queries and members
    that the sketches leave.
    """
    load = queries.join(classes.select("cid", "n"), "cid").groupBy("gid").agg(
        F.ceil(F.sum("n") / QUERY_TOKENS).alias("chunks")
    )
    load = materialized(load, "load")
    asked = queries.join(load, "gid").select(
        "gid", F.pmod(F.xxhash64("cid"), "chunks").alias("chunk"), "cid", "comp"
    )
    opened = members.join(load, "gid").select(
        "gid", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)).alias("chunk"), "cid", "comp"
    )
    left = _sifted(asked, opened, classes, percent)
    asked, opened = left.where("asks").drop("asks"), left.where("NOT asks").drop("asks")
    texts = _texts(docs, classes, asked.select("cid").unionAll(opened.select("cid")))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        links = open_group(_with_tokens(left, words), _with_tokens(right, words), percent)
        return pa.table({
            "a": pa.array([a for a, _ in links], pa.int64()),
            "b": pa.array([b for _, b in links], pa.int64()),
        })

    # Fresh columns by ``toDF``: both sides stem from the same tables.
    left, right = (
        f.join(texts, "cid").select("gid", "chunk", "cid", "comp", "text")
        .toDF("gid", "chunk", "cid", "comp", "text").groupBy("gid", "chunk")
        for f in (asked, opened)
    )
    return left.cogroup(right).applyInArrow(run, "a bigint, b bigint")


def _in_reach(percent: int) -> Column:
    """Of rows (n, reach) beside the smallest set ``low`` and the farthest reach ``best`` of others."""
    return (F.col("reach") >= percent * F.col("low")) & (F.col("best") >= percent * F.col("n"))


def _leading(shared: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Queries (cid, comp, gid) and members (gid, cid, comp): documents, and the leading
    holders of their prefix tokens as groups of one.

    The holder whose order comes to the token first has the fewest tokens of its own; of
    a family of copies it is the common origin. One comparison a row, so that a token
    that very many documents share costs no pairs.
    """
    lead = shared.groupBy("token").agg(F.min(F.struct("pos", "n", "cid")).alias("lead"))
    near = (_reach(percent, F.col("n"), F.col("pos")) >= percent * F.col("lead.n")) & (
        _reach(percent, F.col("lead.n"), F.col("lead.pos")) >= percent * F.col("n")
    )
    pairs = shared.join(lead, "token").where((F.col("cid") != F.col("lead.cid")) & near)
    # Of two that lead each other at different tokens one asks.
    ends = (F.col("cid"), F.col("lead.cid"))
    asks = pairs.select(F.greatest(*ends).alias("x"), F.least(*ends).alias("y"), F.col("lead.cid").alias("gid"))
    once = asks.groupBy("x", "y").agg(F.max("gid").alias("gid"))
    cid = F.when(F.col("gid") == F.col("x"), F.col("y")).otherwise(F.col("x"))
    queries = materialized(once.select(cid.alias("cid"), cid.alias("comp"), "gid"), "led")
    members = queries.select("gid").distinct()
    return queries, members.select("gid", F.col("gid").alias("cid"), F.col("gid").alias("comp"))


def _groups(classes: DataFrame) -> DataFrame:
    """(cid, gid): documents of the same second hash, in blocks of bounded size."""
    sizes = classes.groupBy("like").agg(F.ceil(F.sum("n") / GROUP_TOKENS).alias("blocks"))
    block = F.pmod(F.xxhash64("cid"), "blocks")
    return classes.select("cid", "like").join(sizes, "like").select(
        "cid", F.xxhash64("like", block).alias("gid")
    )


def _meetings(rows: DataFrame, percent: int) -> DataFrame:
    """(cid, comp, gid) of documents and groups that may hold similar ones, from rows (token,
    gid, cid, comp, n, reach, main).

    The matrix is sparse: a row for a token and a group, however many components its members
    are of, with their smallest set and component, their farthest reach, and whether the
    token's main component is there. Documents meet the rows of their prefix tokens. Most
    holders of a frequent token belong to one component by now; those ask nothing, as the
    others ask them.
    """
    matrix = rows.groupBy("token", "gid").agg(
        F.min("n").alias("low"), F.max("reach").alias("best"), F.min("comp").alias("least"),
        F.max(F.col("comp") == F.col("main")).alias("leads"),
    )
    asking = rows.where("comp != main").select("token", "cid", "comp", "n", "reach")
    once = F.col("leads") | (F.col("least") < F.col("comp"))
    return asking.join(matrix, "token").where(once & _in_reach(percent)).select("cid", "comp", "gid")


def _qualifying(
    shared: DataFrame, classes: DataFrame, known: DataFrame, percent: int
) -> tuple[DataFrame, DataFrame]:
    """Queries (cid, comp, gid) and members (gid, cid, comp): documents, and groups that may
    hold similar ones which ``known`` (vertex, component) does not connect with them yet.

    Holders of a token that no other holder can reach do not enter the matrix.
    """
    holders = classes.join(shared.select("cid").distinct(), "cid", "left_semi")
    groups = _groups(holders)
    places = groups.join(known, groups["cid"] == known["vertex"], "left").select(
        "cid", "gid", F.coalesce("component", "cid").alias("comp")
    )
    places = materialized(places, "places")
    reach = _reach(percent, F.col("n"), F.col("pos"))
    rows = shared.join(places, "cid")
    tokens = rows.groupBy("token").agg(
        F.min("comp").alias("least"), F.max("comp").alias("most"),
        F.min(F.struct("pos", "n", "comp"))["comp"].alias("main"),
        F.min("n").alias("low"), F.max(reach).alias("best"),
    )
    open_tokens = tokens.where("least != most").select("token", "main", "low", "best")
    rows = rows.select("token", "gid", "cid", "comp", "n", reach.alias("reach"))
    rows = rows.join(open_tokens, "token").where(_in_reach(percent)).drop("low", "best")
    rows = materialized(rows, "placed")
    queries = materialized(_meetings(rows, percent).distinct(), "asked")
    return queries, places.select("gid", "cid", "comp")


def similar_documents(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text).

    Documents link where the sets of their word shingles have ``percent`` of a hundred or
    more of their union in common; component_id is the smallest doc_id that links reach,
    the document's own included. Equal sets are one vertex. Shingles and
    whole sets are compared by 64-bit hashes. No pairs of a group are laid out: documents are
    first compared with one leading holder of each token of their prefix, and what that
    leaves unconnected goes through the token-group matrix.

    A document without words (null text too) has no shingles and links with nothing. A
    row with a null doc_id takes part and never gives its id; component_id is null where
    all ids are. Repeated rows come out as often as they came in; other columns are
    ignored; no rows give no rows.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    digests = materialized(_digests(docs, words, percent), "digests")
    classes = digests.where("cid IS NOT NULL").groupBy("cid").agg(
        F.first("n").alias("n"), F.first("like").alias("like"), F.first("sketch").alias("sketch"),
        F.min("doc_id").alias("doc_id"),
    )
    classes = materialized(classes, "classes")
    keyed = digests.select(
        F.posexplode("prefix").alias("pos", "token"), "cid", F.col("n").cast("int").alias("n")
    )
    several = keyed.groupBy("token").agg(F.min("cid").alias("a"), F.max("cid").alias("b"))
    shared = keyed.join(several.where("a != b").select("token"), "token").distinct()
    shared = materialized(shared, "shared")
    led = materialized(_opened(*_leading(shared, percent), docs, classes, words, percent), "links")
    known = connected_components(led)
    groups = _qualifying(shared, classes, known, percent)
    rest = materialized(_opened(*groups, docs, classes, words, percent), "links")
    parts = connected_components(led.unionAll(rest))
    labelled = classes.join(parts, classes["cid"] == parts["vertex"], "left").select(
        "cid", "doc_id", F.coalesce("component", "cid").alias("component")
    )
    smallest = labelled.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = labelled.join(smallest, "component").select("cid", "component_id")
    return digests.select("doc_id", "cid", "n").join(named, "cid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def similar_sql(words: int = 4, percent: int = 85) -> str:
    """The same over the table ``documents`` in DuckDB, by counting all common shingles."""
    return rf"""
    WITH RECURSIVE d AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
      FROM documents
    ),
    s AS MATERIALIZED (
      SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(
        range(1, greatest(len(w) - {words - 1}, 1) + 1),
        lambda i: array_to_string(w[i:i + {words - 1}], ' ')))) END AS sh
      FROM d
    ),
    c AS MATERIALIZED (
      SELECT row_number() OVER () AS c, min(doc_id) AS id, sh FROM s WHERE len(sh) > 0 GROUP BY sh
    ),
    t AS MATERIALIZED (SELECT c, len(sh) AS n, unnest(sh) AS token FROM c),
    links AS MATERIALIZED (
      SELECT a.c AS x, b.c AS y FROM t a JOIN t b ON a.token = b.token AND a.c != b.c
      GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))
    ),
    reach(c, r) AS (
      SELECT c, c FROM c UNION SELECT reach.c, links.y FROM reach JOIN links ON links.x = reach.r
    ),
    named AS (
      SELECT reach.c, min(other.id) AS component_id
      FROM reach JOIN c other ON other.c = reach.r GROUP BY reach.c
    )
    SELECT doc_id, len(s.sh) AS n_shingles,
      CASE WHEN len(s.sh) = 0 THEN doc_id ELSE component_id END AS component_id
    FROM s LEFT JOIN c ON c.sh = s.sh LEFT JOIN named ON named.c = c.c
    """

"""The trie of conversations by their turns, from padded matrices of turn ids."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywood.plans.scratch import materialized

# Turns of one shard, about; and columns of a matrix that is laid out at once.
SHARD_TURNS = 200_000
COLUMNS = 32
# Stands after the last turn of a conversation and sorts before every turn.
PAD = np.iinfo(np.int64).min

TURN = "struct<turn: bigint, id: bigint, words: int>"


def turn_id(role: Column, text: Column) -> Column:
    """64-bit hash of a turn; never the value that pads."""
    return F.greatest(F.xxhash64(role, text), F.lit(int(PAD) + 1))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the hashed turns of each conversation in order, null turns first.

    Only a number, a hash and a count of words of each turn are shuffled. Turns of one
    number come in the order of their hashes.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    turn = F.struct(
        F.col("turn").cast("bigint").alias("turn"), turn_id(role, text).alias("id"),
        words.cast("int").alias("words"),
    )
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("t")
    )
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(conversations: DataFrame, family: int = 20, heads: int = 4) -> DataFrame:
    """(conv_id, ids, words) of conversations that begin like the first of their family.

    Conversation c gets the first h turns of conversation c - c % family (all, if there
    are fewer), then its own turns after its first h, with h = crc32(c) % heads. ``%``
    has the sign of c, as in SQL.
    """
    own = materialized(numbered_turns(conversations), "turns")
    first = own.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, heads - 1).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    based = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % family)
    joined = based.join(first, "base", "left").withColumn("h", h)
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.array().cast(f"array<{TURN}>"))
    tail = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    turns = joined.select("conv_id", F.concat(head, tail).alias("turns"))
    return turns.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.words").alias("words"))


def _sharded(rows: DataFrame) -> DataFrame:
    """Rows with ``shard``: ranges of (ids, conv_id), written so that they stay as they are."""
    turns = rows.agg(F.sum(F.size("ids") + 1)).head()[0] or 0
    shards = max(1, -(-turns // SHARD_TURNS))
    ranged = rows.repartitionByRange(shards, "ids", "conv_id")
    return materialized(ranged.withColumn("shard", F.spark_partition_id()), "shards")


def _common(a: str, b: str) -> Column:
    """How many first elements two arrays share; 0 if one is missing."""
    shorter = F.least(F.size(a), F.size(b))
    differ = F.filter(
        F.sequence(F.lit(1), shorter),
        lambda i: F.element_at(a, i.cast("int")) != F.element_at(b, i.cast("int")),
    )
    shared = F.coalesce(F.array_min(differ) - 1, shorter)
    return F.when(shorter > 0, shared).otherwise(0)


def _edges(sharded: DataFrame) -> DataFrame:
    """(shard, before, after): depth of the path shared with the neighbouring shards, -1 for none.

    Two rows a shard; the window over all shards sees their numbers only.
    """
    ends = materialized(
        sharded.groupBy("shard").agg(F.min("ids").alias("low"), F.max("ids").alias("high")), "ends"
    )
    order = Window.orderBy("shard")
    follows = ends.select("shard", F.lead("shard").over(order).alias("next"))
    lows = ends.select(F.col("shard").alias("next"), F.col("low").alias("next_low"))
    cuts = follows.join(lows, "next").join(ends.select("shard", "high"), "shard").select(
        "shard", "next", _common("high", "next_low").alias("shared")
    )
    cuts = materialized(cuts, "cuts")
    after = cuts.select("shard", F.col("shared").alias("after"))
    before = cuts.select(F.col("next").alias("shard"), F.col("shared").alias("before"))
    return (
        ends.select("shard").join(after, "shard", "left").join(before, "shard", "left")
        .fillna(-1, ["before", "after"])
    )


def _padded(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray, at: int) -> np.ndarray:
    """Columns ``at`` and on of the matrix of ids, with PAD after the last id."""
    width = min(COLUMNS, int(lens.max(initial=0)) - at)
    column = np.arange(at, at + width)
    there = column[None, :] < lens[:, None]
    place = np.where(there, starts[:, None] + column[None, :], 0)
    return np.where(there, flat[place] if len(flat) else PAD, PAD)


def _sorted(flat, starts, lens, conv) -> np.ndarray:
    """Order of the conversations by their padded rows, then by id: lexsorts of blocks of
    columns, each of the rows that are alike so far."""
    order = np.argsort(conv, kind="stable")
    groups = np.zeros(len(conv), dtype=np.int64)
    at = 0
    alike = np.arange(len(conv))
    while len(alike):
        rows = order[alike]
        matrix = _padded(flat, starts[rows], lens[rows], at)
        if not matrix.shape[1]:
            break
        keys = [matrix[:, j] for j in range(matrix.shape[1] - 1, -1, -1)]
        by = np.lexsort([*keys, groups[alike]])
        order[alike] = rows[by]
        matrix, was = matrix[by], groups[alike]
        new = np.ones(len(alike), dtype=bool)
        new[1:] = (was[1:] != was[:-1]) | (matrix[1:] != matrix[:-1]).any(axis=1)
        # Groups keep their places: the number of a group is that of its first row.
        groups[alike] = alike[np.maximum.accumulate(np.where(new, np.arange(len(alike)), 0))]
        at += COLUMNS
        longer = lens[order[alike]] > at
        first = np.searchsorted(groups[alike], groups[alike], "left")
        last = np.searchsorted(groups[alike], groups[alike], "right")
        alike = alike[longer & (last - first > 1)]
    return order


class _Nodes:
    """Nodes of one shard, level by level, each level in the order of its rows."""

    def __init__(self, flat, words, starts, lens, conv):
        n = len(conv)
        self.levels: list[dict] = [{
            "parent": np.zeros(1, dtype=np.int64), "count": np.array([n]),
            "conv": np.array([conv.min()]), "words": np.zeros(1, dtype=np.int64),
            "row": np.zeros(1, dtype=np.int64),
        }]
        self.at_node = np.zeros(n, dtype=np.int64)  # of each row, its node on the last level
        active = np.flatnonzero(lens > 0)
        node = np.zeros(len(active), dtype=np.int64)
        at = 0
        while len(active):
            matrix = _padded(flat, starts[active], lens[active], at)
            change = np.ones(matrix.shape, dtype=bool)
            differs = np.concatenate([(node[1:] != node[:-1])[:, None], matrix[1:] != matrix[:-1]], axis=1)
            change[1:] = np.logical_or.accumulate(differs, axis=1)[:, 1:]
            for j in range(matrix.shape[1]):
                there = np.flatnonzero(matrix[:, j] != PAD)
                begins = np.flatnonzero(change[there, j])
                rows = active[there]
                first = rows[begins]
                self.levels.append({
                    "parent": node[there][begins],
                    "count": np.diff(np.append(begins, len(there))),
                    "conv": np.minimum.reduceat(conv[rows], begins),
                    "words": words[starts[first] + at + j].astype(np.int64),
                    "row": first,
                })
                node[there] = np.cumsum(change[there, j]) - 1
                self.at_node[rows] = node[there]
            at += matrix.shape[1]
            left = lens[active] > at
            active, node = active[left], node[left]

    def path(self, depth: int, row: int) -> list[int]:
        """Numbers of the nodes on the path of a row, down to a depth."""
        path = []
        for level in self.levels[: depth + 1]:
            path.append(int(np.searchsorted(level["row"], row, "right") - 1))
        return path


def _shard_nodes(shard: int, before: int, after: int, conv, lens, flat, words) -> list[dict]:
    """Rows of one shard's nodes; those on an edge shared with another shard are partial."""
    starts = np.concatenate([[0], np.cumsum(lens)[:-1]])
    order = _sorted(flat, starts, lens, conv)
    conv, lens, starts = conv[order], lens[order], starts[order]
    nodes = _Nodes(flat, words, starts, lens, conv)
    levels = nodes.levels
    # The root is taken as shared in any case. A shared node counts where it comes last.
    first, last = nodes.path(max(before, 0), 0), nodes.path(max(after, 0), len(conv) - 1)
    for depth, level in enumerate(levels):
        size = len(level["count"])
        level["owned"] = np.ones(size, dtype=bool)
        if depth <= after:
            level["owned"][last[depth]] = False
        level["children"], level["heirs"] = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        level["all"] = level["count"] * level["words"]
        level["once"] = np.where(level["owned"], level["words"], 0)
    leaves = None
    for depth in range(len(levels) - 1, -1, -1):
        level = levels[depth]
        # ``heirs`` counts children whoever owns them, ``children`` those owned here.
        level["leaves"] = (level["heirs"] == 0) & level["owned"]
        level["leaves"] = level["leaves"].astype(np.int64) + (0 if leaves is None else leaves)
        if depth:
            up, parent = levels[depth - 1], level["parent"]
            begins = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
            at = parent[begins]
            up["heirs"][at] = np.diff(np.append(begins, len(parent)))
            up["children"][at] = np.add.reduceat(level["owned"].astype(np.int64), begins)
            up["all"][at] += np.add.reduceat(level["all"], begins)
            up["once"][at] += np.add.reduceat(level["once"], begins)
            leaves = np.zeros(len(up["count"]), dtype=np.int64)
            leaves[at] = np.add.reduceat(level["leaves"], begins)
    return _rows(shard, levels, (first, last), conv, lens, flat, starts, nodes.at_node)


def _path_keys(flat, start: int, depth: int) -> list[bytes]:
    """128-bit keys of the first ``depth`` prefixes of a row and of the empty one."""
    hashed = hashlib.blake2b(digest_size=16)
    keys = [hashed.digest()]
    for d in range(depth):
        hashed.update(int(flat[start + d]).to_bytes(8, "little", signed=True))
        keys.append(hashed.digest())
    return keys


COLUMNS_OUT = [
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
    ("key", pa.binary()), ("parent_key", pa.binary()), ("shard", pa.int64()),
    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
    ("all_words", pa.int64()), ("once_words", pa.int64()), ("ends", pa.string()),
    ("ends_sha256", pa.string()),
]
SCHEMA_OUT = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, key binary, parent_key binary, "
    "shard bigint, n_convs bigint, n_children bigint, n_leaves bigint, all_words bigint, "
    "once_words bigint, ends string, ends_sha256 string"
)
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _rows(shard, levels, paths, conv, lens, flat, starts, at_node) -> list[dict]:
    keys: list[dict] = [{} for _ in levels]
    for path, row in zip(paths, (0, len(conv) - 1)):
        for depth, key in enumerate(_path_keys(flat, int(starts[row]), len(path) - 1)):
            keys[depth][path[depth]] = key
    by_end = np.argsort(lens, kind="stable")
    end_lens = lens[by_end]
    out = []
    for depth, level in enumerate(levels):
        size = len(level["count"])
        ends: dict[int, str] = {}
        rows = by_end[np.searchsorted(end_lens, depth, "left") : np.searchsorted(end_lens, depth, "right")]
        if len(rows):
            node = at_node[rows]
            begins = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            for a, b in zip(begins, np.append(begins[1:], len(rows))):
                ends[int(node[a])] = ",".join(map(str, conv[rows[a:b]].tolist()))
        own = [keys[depth].get(i) for i in range(size)]
        parent, above, none = level["parent"], [], []
        if depth:
            above = [keys[depth - 1].get(p) for p in parent.tolist()]
            none = [key is not None for key in above]
        texts = [ends.get(i, "") for i in range(size)]
        known = pa.array(levels[depth - 1]["conv"][parent], mask=np.array(none)) if depth else None
        out.append({
            "conv_id": level["conv"], "depth": np.full(size, depth),
            "parent_conv_id": known if depth else [None] * size,
            "key": own, "parent_key": above if depth else [None] * size,
            "shard": np.full(size, shard), "n_convs": level["count"],
            "n_children": level["children"], "n_leaves": level["leaves"],
            "all_words": level["all"], "once_words": level["once"],
            "ends": [t if k is not None else None for t, k in zip(texts, own)],
            "ends_sha256": [
                None if k is not None else hashlib.sha256(t.encode()).hexdigest() if t else NO_ENDS
                for t, k in zip(texts, own)
            ],
        })
    return out


def _partial_nodes(sharded: DataFrame) -> DataFrame:
    """Nodes of every shard: whole ones, and the parts of shared ones."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        lens = np.diff(rows.column("ids").combine_chunks().offsets.to_numpy()).astype(np.int64)
        flat, words = (
            rows.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("ids", "words")
        )
        conv = rows.column("conv_id").to_numpy()
        shard, before, after = (rows.column(c)[0].as_py() for c in ("shard", "before", "after"))
        levels = _shard_nodes(shard, before, after, conv, lens, flat, words)
        schema = pa.schema(COLUMNS_OUT)
        return pa.Table.from_batches([
            pa.RecordBatch.from_arrays([pa.array(level[n], t) for n, t in COLUMNS_OUT], schema=schema)
            for level in levels
        ])

    edged = sharded.join(_edges(sharded), "shard")
    return edged.groupBy("shard").applyInArrow(run, SCHEMA_OUT)


def _ends_digests(parts: DataFrame) -> DataFrame:
    """(key, ends_sha256) of shared nodes: one hash over the shards' pieces in order.

    A hash is a chain, so the pieces of a node pass one task, one after another; each
    holds the ids of one shard, and none is kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, hashed, some = None, None, False
        for batch in batches:
            done: list[tuple] = []
            for k, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if k != key:
                    if key is not None:
                        done.append((key, hashed.hexdigest()))
                    key, hashed, some = k, hashlib.sha256(), False
                if piece:
                    hashed.update(f",{piece}".encode() if some else piece.encode())
                    some = True
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())],
                ["key", "ends_sha256"],
            )
        if key is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([key], pa.binary()), pa.array([hashed.hexdigest()])], ["key", "ends_sha256"]
            )

    pieces = parts.select("key", "shard", "ends").repartition("key")
    return pieces.sortWithinPartitions("key", "shard").mapInArrow(run, "key binary, ends_sha256 string")


def trie_nodes(rows: DataFrame) -> DataFrame:
    """Nodes of the trie of sequences ``rows`` (conv_id bigint, ids array<bigint>, words array<int>).

    A node is a distinct prefix, the empty one included; its columns are those of
    ``conversation_trie``. Sequences are ranged over shards by (ids, conv_id). In a shard,
    blocks of columns of the padded matrix are lexsorted, changes between neighbouring
    rows OR-ed from the first column on mark where nodes begin, and ``reduceat`` adds up
    each level. Only prefixes that the end of one shard and the start of the next have in
    common lie in several shards: their parts are added up by a hash of the prefix. Such
    a node, as a child, a leaf and for its words, counts in the last shard it lies in.
    One sequence must fit a task, 12 bytes an element; groups of alike ones need not.
    """
    sharded = _sharded(rows)
    parts = materialized(_partial_nodes(sharded), "nodes")
    shared = parts.where("key IS NOT NULL")
    joined = shared.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        F.first("parent_key").alias("parent_key"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "all_words", "once_words")),
    )
    joined = materialized(joined.join(_ends_digests(shared), "key"), "shared-nodes")
    names = ["conv_id", "depth", "parent_conv_id", "parent_key", "n_convs", "n_children",
             "n_leaves", "all_words", "once_words", "ends_sha256"]
    unset = joined.withColumn("parent_conv_id", F.lit(None).cast("bigint"))
    nodes = parts.where("key IS NULL").select(*names).unionAll(unset.select(*names))
    parents = joined.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("joined_parent"))
    return nodes.join(parents, "parent_key", "left").select(
        "conv_id", "depth",
        F.coalesce("parent_conv_id", "joined_parent").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves",
        (F.col("all_words") - F.col("once_words")).alias("saved_tokens"), "ends_sha256",
    )


def conversation_trie(conversations: DataFrame, family: int = 20, heads: int = 4) -> DataFrame:
    """One row per node of the trie of rebuilt ``conversations`` (conv_id, turn, role, text).

    Turns are ordered by number, null first, those of one number by their hash; a null
    role or text is empty; turns are compared by 64-bit hashes. Conversations are rebuilt
    by ``rebuilt``. A row with a null conv_id belongs to no conversation and is left out;
    a repeated row is a turn of its own; other columns are ignored; no conversations give
    no nodes. Columns: conv_id (smallest member), depth, parent_conv_id (null for the
    root), n_convs, n_children, n_leaves, saved_tokens (what the members after the first
    need not read again, over the subtree) and ends_sha256 (of the ids of the members
    that end at the node).
    """
    return trie_nodes(rebuilt(conversations, family, heads))


def trie_sql(family: int = 20, heads: int = 4) -> str:
    """The same over the table ``conversations`` in DuckDB, by grouping all prefixes."""
    crc = """list_reduce(list_concat([4294967295::BIGINT],
        list_transform(string_split(CAST({c} AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
        lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
          lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))"""
    h = f"CAST(xor({crc.format(c='conv_id')}, 4294967295) % {heads} AS BIGINT)"
    return rf"""
    WITH own AS (
      SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
        ORDER BY turn NULLS FIRST, role, text) AS turns
      FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
    ),
    numbered AS (SELECT *, {h} AS h FROM own),
    seqs AS (
      SELECT a.conv_id,
        list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS turns
      FROM numbered a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % {family}
    ),
    paths AS (
      SELECT conv_id, len(turns) AS n, d, turns[1:d] AS path
      FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM seqs)
    ),
    nodes AS (
      SELECT d, path, min(conv_id) AS conv_id, count(*) AS n_convs,
        coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
          FILTER (WHERE n = d), '') AS ends,
        CASE WHEN d > 0 THEN (count(*) - 1)
          * len(regexp_extract_all(path[d].t, '[^\x20\x09-\x0D]+')) ELSE 0 END AS saved
      FROM paths GROUP BY d, path
    ),
    children AS (SELECT d - 1 AS d, path[1:d - 1] AS path, count(*) AS c FROM nodes WHERE d > 0 GROUP BY ALL),
    counted AS (SELECT nodes.*, coalesce(c, 0) AS n_children FROM nodes LEFT JOIN children USING (d, path)),
    up AS (
      SELECT path[1:a] AS path, sum(saved) AS saved_tokens,
        count(*) FILTER (WHERE n_children = 0) AS n_leaves
      FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM counted) GROUP BY ALL
    )
    SELECT c.conv_id, c.d AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children,
      up.n_leaves, CAST(up.saved_tokens AS BIGINT) AS saved_tokens, sha256(c.ends) AS ends_sha256
    FROM counted c JOIN up ON up.path = c.path
      LEFT JOIN nodes p ON c.d > 0 AND p.d = c.d - 1 AND p.path = c.path[1:c.d - 1]
    """

"""K-means over lines of points: a step costs by lines and centers, not by rows and centers.

Rows that agree in all columns but one lie on a line. Along a line the distances to two
centers differ by a linear function, so every center is the nearest on one stretch at
most, and the stretches follow each other by the centers' places on the line's own column.
A step finds the ends of the stretches, and takes the rows of each from running sums.

It is exact whatever the data look like. Columns with few values besides one with many
make long lines; where every row has a line of its own it is a plain scan of all centers.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.learning.sweep import Clustering, finite_rows, moved_until_settled, task_sums
from tallywood.plans import materialized, shipped

# Lines and points handled at a time; they bound a task's memory.
LINES_AT_ONCE, POINTS_AT_ONCE = 1024, 1 << 18
# Rows that a file of lines is made from.
ROWS_A_FILE = 1_000_000
# Lines of so few points are compared point by point.
SHORT = 32
# Distances between points and centers held at a time.
CELLS_AT_ONCE = 1 << 17
# Sampling rounds of the start, points drawn a round as a multiple of the centers, and
# steps on the drawn points: those of Spark's k-means||.
ROUNDS, OVERSAMPLING, START_STEPS = 2, 2, 30


@dataclass(frozen=True)
class Lines:
    """Lines as a written table, and which column runs along them.

    The table has columns (keep.., first, at, x, n): ``x`` and ``n`` are a line's points and
    their numbers as packed doubles and longs, which no engine has to take apart; ``n`` is empty where
    every point of a line is one row. ``first`` is the first point.
    """

    table: DataFrame
    columns: tuple[str, ...]
    along: int


@dataclass(frozen=True)
class _Block:
    """Some lines: their places, and points ``x`` with counts ``n`` from first to last."""

    at: np.ndarray
    x: np.ndarray
    n: np.ndarray
    first: np.ndarray
    last: np.ndarray


def together(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> tuple[DataFrame, int]:
    """Different rows (keys.., columns..) with their number ``n``, those that agree in all but one column lying together.

    That column is the one with the most distinct values; its place is told as well. Equal rows are
    counted before they are dealt out, and by all columns, so that nothing is gathered in one place.
    """
    spread = df.agg(F.count(F.lit(1)).alias("rows"), *[F.approx_count_distinct(c).alias(f"v{i}") for i, c in enumerate(columns)]).head()
    along = max(range(len(columns)), key=lambda i: spread[f"v{i}"])
    order = [*(c for i, c in enumerate(columns) if i != along), columns[along], *keys]
    counted = df.groupBy(*order).agg(F.count(F.lit(1)).alias("n"))
    ranged = counted.repartitionByRange(_parts(df, spread["rows"]), *order).sortWithinPartitions(*order)
    return materialized(ranged, "together"), along


def _parts(df: DataFrame, rows: int) -> int:
    """As many files as keep all cores busy, scan after scan, and of a bounded size."""
    return max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_A_FILE))


def lines(
    df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), along: int | None = None, number: str | None = None
) -> Lines:
    """The rows' values laid out as lines; rows that differ in ``keep`` lie on different ones.

    The column with the most distinct values runs along the lines, if none is named. Equal rows are counted
    first, and long lines are cut, so no line is gathered in one place. Rows with a null,
    NaN or infinite value are left out.

    With ``number``, the column that tells how often a row occurs, rows are laid out where they lie, without
    a shuffle: lines are the longer the more of their rows lie together already, and the result is the same.
    """
    names = [f"v{i}" for i in range(len(columns))]
    more = [F.col(f"`{c}`").alias(f"_keep{i}") for i, c in enumerate(keep)]
    if number is not None:
        more.append(F.col(f"`{number}`").cast("bigint").alias("n"))
    rows = finite_rows(df, columns, *more)
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), _parts(df, 0))
    if along is None:
        spread = rows.agg(F.count(F.lit(1)).alias("rows"), *[F.approx_count_distinct(v).alias(v) for v in names]).head()
        along, parts = max(range(len(names)), key=lambda i: spread[f"v{i}"]), _parts(df, spread["rows"])
    others = [v for i, v in enumerate(names) if i != along]
    kept = [f"_keep{i}" for i in range(len(keep))]
    order = [*kept, *others, names[along]]
    shipped(spark)
    if number is None:
        counted = rows.groupBy(*order).agg(F.count(F.lit(1)).alias("n"))
        dealt = counted.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    else:
        dealt = rows.select(*order, "n")

    def laid(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        some = pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
        codes = [
            some.column(i).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            for i in range(len(kept))
        ]
        *values, x, n = (v.to_numpy(zero_copy_only=False) for v in some.columns[len(kept) :])
        rank = np.arange(len(x))
        if number is not None:
            rank = np.lexsort([x, *(v for v in [*values, *codes] if v.min() < v.max())])
            codes, values, x, n = [v[rank] for v in codes], [v[rank] for v in values], x[rank], n[rank]
        new = np.zeros(len(x), dtype=bool)
        new[0] = True
        for v in [*codes, *values]:
            new[1:] |= v[1:] != v[:-1]
        if number is not None:
            # Rows told apart by a column that is not asked for are one point.
            first = np.flatnonzero(new | np.append(True, x[1:] != x[:-1]))
            n, x, new, rank = np.add.reduceat(n, first), x[first], new[first], rank[first]
            values = [v[first] for v in values]
        starts = np.flatnonzero(new)
        size = np.diff(np.append(starts, len(x)))
        many = np.add.reduceat(n, starts) > size
        at = np.column_stack(values)[starts] if values else np.zeros((len(starts), 0))
        places = pa.array(np.arange(len(starts) + 1) * len(others), pa.int32())
        packed = [(x.astype(np.float64), size), (n[np.repeat(many, size)].astype(np.int64), np.where(many, size, 0))]
        return pa.RecordBatch.from_arrays(
            [
                *[some.column(i).take(pa.array(rank[starts])) for i in range(len(kept))],
                pa.array(x[starts]), pa.ListArray.from_arrays(places, pa.array(at.ravel(), pa.float64())),
                *[_packed(v, each) for v, each in packed],
            ],
            [*kept, "first", "at", "x", "n"],
        )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                size += batch.num_rows
            if size >= POINTS_AT_ONCE:
                yield laid(waiting)
                waiting, size = [], 0
        if waiting:
            yield laid(waiting)

    kinds = dict(rows.dtypes)
    schema = ", ".join([*[f"{k} {kinds[k]}" for k in kept], "first double, at array<double>, x binary, n binary"])
    table = materialized(dealt.mapInArrow(gather, schema), "lines")
    return Lines(table.withColumnsRenamed(dict(zip(kept, keep))), tuple(columns), along)


def _packed(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Numbers of 8 bytes as packed ones, so many a row."""
    places = pa.array(np.append(0, np.cumsum(sizes)) * 8, pa.int32())
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, places.buffers()[1], pa.py_buffer(values)])


def _unpacked(column: pa.Array, kind: type) -> np.ndarray:
    """All numbers of a column of packed ones, one after the other."""
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, places, packed = column.buffers()
    places = np.frombuffer(places, wide)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(packed, np.uint8)[places[0] : places[-1]].view(kind)


def _blocks(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, _Block]]:
    """Lines of a batch whose last columns are at, x and n, some at a time, with the first's number."""
    if not batch.num_rows:
        return
    at, x, n = batch.columns[-3:]
    sizes = pc.binary_length(x).to_numpy(zero_copy_only=False).astype(np.int64) // 8
    at = at.flatten().to_numpy(zero_copy_only=False).reshape(len(sizes), width - 1)
    x, many, packed = _unpacked(x, np.float64), pc.binary_length(n).to_numpy(zero_copy_only=False) > 0, n
    n = np.ones(len(x), dtype=np.int64)
    if many.any():
        n[np.repeat(many, sizes)] = _unpacked(packed, np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        begin = ends[start] - sizes[start]
        stop = np.searchsorted(ends, begin + POINTS_AT_ONCE, side="right")
        stop = min(max(stop, start + 1), start + LINES_AT_ONCE)
        last = ends[start:stop] - begin
        some = slice(begin, ends[stop - 1])
        yield start, _Block(at[start:stop], x[some], n[some], last - sizes[start:stop], last)
        start = stop


def _reach(x: np.ndarray, low: np.ndarray, high: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """The first place from ``low`` to ``high`` with a value above the limit, for each."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) // 2
        up = open_ & (x[np.minimum(middle, len(x) - 1)] <= limit)
        low = np.where(up, middle + 1, low)
        high = np.where(open_ & ~up, middle, high)


def _least(high: np.ndarray, line: np.ndarray, x: np.ndarray, twice: np.ndarray) -> np.ndarray:
    """The center nearest to ``x`` on each of the lines, some at a time."""
    near = np.empty(len(line), dtype=np.int64)
    each = max(CELLS_AT_ONCE // len(twice), 1)
    for start in range(0, len(line), each):
        some = slice(start, start + each)
        away = high[line[some]]
        away -= x[some, None] * twice
        near[some] = away.argmin(axis=1)
    return near


def _stretches(
    block: _Block, centers: np.ndarray, along: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Arrays (line, nearest center, from, to) that cover every point of the block once.

    A point as near to several centers goes to one of them. Where two centers that are
    nearest at two places of a line meet, either these two or one between them is nearest;
    so the ends of all stretches of all lines are found in as many rounds as a line's
    stretches can be halved, with two looks at all centers a stretch.
    """
    order = np.argsort(centers[:, along], kind="stable")
    c, own = centers[order, along], np.delete(centers, along, axis=1)[order]
    lengths, twice = (own**2).sum(axis=1) + c**2, 2 * c
    size = block.last - block.first
    short = size <= SHORT
    if short.any():
        owner = np.repeat(np.arange(len(size)), size)
        points = np.flatnonzero(short[owner])
        both = np.column_stack([own, c]).T
        each = max(CELLS_AT_ONCE // len(c), 1)
        near = np.empty(len(points), dtype=np.int64)
        for start in range(0, len(points), each):
            some = points[start : start + each]
            whole = np.column_stack([block.at[owner[some]], block.x[some]])
            near[start : start + each] = (lengths - 2 * whole @ both).argmin(axis=1)
        # Neighbours on a line with the same center are one stretch.
        line = owner[points]
        new = np.flatnonzero(np.append(True, (line[1:] != line[:-1]) | (near[1:] != near[:-1])))
        end = points[np.append(new[1:], len(points)) - 1] + 1
        yield line[new], order[near[new]], points[new], end
        if short.all():
            return
    line = np.flatnonzero(~short)
    first, last = block.first[line], block.last[line]
    # Distance to a center at x, less what all centers have in common: high - 2 c x.
    high = lengths - 2 * block.at[line] @ own.T
    each = np.arange(len(line))
    now, then = _least(high, each, block.x[first], twice), _least(high, each, block.x[last - 1], twice)
    held = [(each, now, np.full(len(line), -np.inf))]
    line_, now, then = (v[now < then] for v in (each, now, then))
    while len(line_):
        gap, meets = twice[then] - twice[now], np.full(len(line_), -np.inf)
        np.divide(high[line_, then] - high[line_, now], gap, out=meets, where=gap > 0)
        some = np.flatnonzero(gap > 0)
        between = now.copy()
        between[some] = _least(high, line_[some], meets[some], twice)
        split = (now < between) & (between < then)
        held.append((line_[~split], then[~split], meets[~split]))
        line_ = np.concatenate([line_[split], line_[split]])
        now, then = np.concatenate([now[split], between[split]]), np.concatenate([between[split], then[split]])
    which, near, meets = (np.concatenate(v) for v in zip(*held))
    sort = np.lexsort([near, which])
    which, near, meets = which[sort], near[sort], meets[sort]
    # Centers that meet at one place may do so out of order by a rounding.
    start = np.maximum.accumulate(_reach(block.x, first[which], last[which], meets))
    new = np.append(True, which[1:] != which[:-1])
    end = np.where(np.append(new[1:], True), last[which], np.append(start[1:], 0))
    some = end > start
    yield line[which[some]], order[near[some]], start[some], end[some]


def _running(block: _Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Running sums of n, n x and n x x over the block's points, with a zero before."""
    sums = np.zeros((3, len(block.x) + 1), dtype=np.longdouble)
    weighted = block.x.astype(np.longdouble)
    if (block.n != 1).any():
        weighted *= block.n
    for held, v in zip(sums, (block.n, weighted, weighted * block.x)):
        np.cumsum(v, out=held[1:])
    return sums[0], sums[1], sums[2]


def _sums(
    block: _Block, running: tuple[np.ndarray, np.ndarray, np.ndarray], centers: np.ndarray, along: int,
    held: np.ndarray,
) -> None:
    """Adds (n, cost, sums of the columns) of every center's points to ``held``."""
    n, x, xx = running
    others = np.delete(np.arange(centers.shape[1]), along)
    for line, near, start, end in _stretches(block, centers, along):
        size, total = (n[end] - n[start]).astype(float), x[end] - x[start]
        at, c = block.at[line], centers[near, along]
        apart = ((at - centers[near][:, others]) ** 2).sum(axis=1)
        cost = size * apart + (xx[end] - xx[start]) - 2 * c * total + c * c * size
        for place, values in [(0, size), (1, np.maximum(cost, 0)), (2 + along, total)]:
            held[:, place] += np.bincount(near, values.astype(float), len(centers))
        for i, j in enumerate(others):
            held[:, 2 + j] += np.bincount(near, size * at[:, i], len(centers))


def _scanned(held: Lines, keep: Sequence[str] = ()) -> DataFrame:
    return held.table.select(*keep, "at", "x", "n")


def cluster_sums(held: Lines, centers: dict[int, np.ndarray]) -> DataFrame:
    """Rows (k, cluster, n, cost, s0, s1, ...) of the non-empty clusters of every k, by one scan."""
    width, along = len(held.columns), held.along

    def added(batches: Iterator[pa.RecordBatch], sums: dict[int, np.ndarray]) -> None:
        for batch in batches:
            for _, block in _blocks(batch, width):
                running = _running(block)
                for k, own in centers.items():
                    _sums(block, running, own, along, sums[k])

    return task_sums(_scanned(held), centers, width, added)


def _mixed(bits: np.ndarray) -> np.ndarray:
    """SplitMix64's finish of unsigned 64-bit numbers."""
    bits = (bits ^ (bits >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    bits = (bits ^ (bits >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return bits ^ (bits >> np.uint64(31))


def _draws(block: _Block, seed: int) -> np.ndarray:
    """A number from 0 to 1 for every point, from its values and the seed alone."""
    owner = np.full(len(block.at), seed, dtype=np.uint64)
    for j in range(block.at.shape[1]):
        owner = _mixed(owner + np.ascontiguousarray(block.at[:, j]).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    points = _mixed(np.repeat(owner, block.last - block.first) + block.x.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return (points >> np.uint64(11)) / float(1 << 53)


def _drawn(held: Lines, centers: np.ndarray, cost: float, wanted: int, seed: int) -> np.ndarray:
    """Points drawn by their squared distance to the centers, ``wanted`` of them expected."""
    width, along = len(held.columns), held.along

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, block in _blocks(batch, width):
                apart = np.zeros(len(block.x))
                others = np.delete(centers, along, axis=1)
                for line, near, start, end in _stretches(block, centers, along):
                    size = end - start
                    which = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
                    beside = ((block.at[line] - others[near]) ** 2).sum(axis=1)
                    apart[which] = np.repeat(beside, size) + (block.x[which] - np.repeat(centers[near, along], size)) ** 2
                some = np.flatnonzero(_draws(block, seed) * cost < wanted * block.n * apart)
                if len(some):
                    owner = np.searchsorted(block.last, some, side="right")
                    points = np.insert(block.at[owner], along, block.x[some], axis=1)
                    places = pa.array(np.arange(len(some) + 1) * width, pa.int32())
                    flat = pa.array(points.ravel(), pa.float64())
                    yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(places, flat)], ["point"])

    found = _scanned(held).mapInArrow(run, "point array<double>").collect()
    return np.array(sorted(r["point"] for r in found), dtype=float).reshape(len(found), width)


def _start(points: np.ndarray, sizes: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centers by k-means++ and some steps on weighted points, fewer than k if they are few."""
    if len(points) <= k:
        return points.copy()
    rng = np.random.default_rng([seed, k])
    chosen = [int(rng.choice(len(points), p=sizes / sizes.sum()))]
    apart = ((points - points[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < k:
        weight = sizes * apart
        chosen.append(int(rng.choice(len(points), p=weight / weight.sum())))
        apart = np.minimum(apart, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
        if not (sizes * apart).any():
            break
    centers = points[chosen].copy()
    for _ in range(START_STEPS):
        near = ((points[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        size = np.bincount(near, sizes, len(centers))
        sums = np.column_stack([np.bincount(near, sizes * v, len(centers)) for v in points.T])
        after = np.where(size[:, None] > 0, sums / np.maximum(size, 1e-300)[:, None], centers)
        if (after == centers).all():
            break
        centers = after
    return centers


def starts(held: Lines, ks: Sequence[int], seed: int = 1) -> dict[int, np.ndarray]:
    """Starting centers of every k by k-means||, with points drawn once, for the largest.

    Draws are by squared distance over all rows, in ``ROUNDS`` scans; each k then chooses
    from the same drawn points by k-means++, each weighted by the rows nearest to it. A k
    of more than the distinct points starts with these. Only drawn points reach the driver.
    """
    first = held.table.select("at", "first")
    one = first.orderBy(F.xxhash64("at", "first", F.lit(seed)), "at", "first").limit(1).head()
    if one is None:
        return {k: np.zeros((0, len(held.columns))) for k in ks}
    points = np.insert(np.array([one["at"]], dtype=float).reshape(1, -1), held.along, one["first"], axis=1)
    wanted = OVERSAMPLING * max(ks)
    for step in range(ROUNDS):
        cost = sum(r["cost"] for r in cluster_sums(held, {0: points}).collect())
        more = _drawn(held, points, cost, wanted, seed * ROUNDS + step) if cost > 0 else points
        points = np.unique(np.concatenate([points, more]), axis=0)
    sizes = np.zeros(len(points))
    for row in cluster_sums(held, {0: points}).collect():
        sizes[row["cluster"]] = row["n"]
    return {k: _start(points, sizes, k, seed) for k in ks}


def fit_all(
    held: Lines, ks: Sequence[int], iterations: int = 40, tolerance: float = 1e-5, seed: int = 1
) -> dict[int, Clustering]:
    """Lloyd's steps for all ``ks`` together, one scan of the lines a step.

    A k stops when no center moves further than ``tolerance``; an empty cluster keeps its
    center. Without rows there are no centers.
    """
    if not ks or min(ks) < 1:
        raise ValueError("numbers of clusters are 1 or more")
    centers = starts(held, ks, seed)
    return moved_until_settled(lambda some: cluster_sums(held, some), centers, iterations, tolerance)


def costs(held: Lines, fitted: dict[int, Clustering]) -> DataFrame:
    """Rows (k, n_clusters, cost): non-empty clusters and summed squared distance."""
    sums = cluster_sums(held, {k: f.centers for k, f in fitted.items() if len(f.centers)})
    return sums.groupBy("k").agg(F.count(F.lit(1)).alias("n_clusters"), F.sum("cost").alias("cost"))


def label_counts(held: Lines, fitted: dict[int, Clustering], label: str) -> DataFrame:
    """Rows (k, cluster, label, count) of lines that keep the label, by one scan.

    Lines hand on one row a stretch's cluster, so rows are never spread out over k.
    """
    width, along = len(held.columns), held.along
    ks = sorted(k for k, f in fitted.items() if len(f.centers))
    kind = held.table.schema[label].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, block in _blocks(batch, width):
                n = np.concatenate([[0], np.cumsum(block.n)])
                for k in ks:
                    for line, near, start, end in _stretches(block, fitted[k].centers, along):
                        some = end > start
                        size = (n[end] - n[start])[some]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(size), k), pa.int32()), pa.array(near[some], pa.int32()),
                                batch.column(0).take(pa.array(begin + line[some])), pa.array(size, pa.int64()),
                            ],
                            ["k", "cluster", "label", "n"],
                        )

    found = _scanned(held, [label]).mapInArrow(run, f"k int, cluster int, label {kind}, n bigint")
    return found.groupBy("k", "cluster", F.col("label").alias(label)).agg(F.sum("n").alias("count"))

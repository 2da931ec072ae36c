"""Toxicity scores by a factorization machine over hashed terms."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywood.llm.decontaminate import words_of
from tallywood.llm.frames import texts_of
from tallywood.llm.words import Memory
from tallywood.plans.scratch import materialized

# Hashed terms are numbers below this.
TERM_SPACE = 1 << 24
# Most labelled rows of either class that the model is fitted on.
SAMPLE_ROWS = 10_000
# Most terms chosen by their own evidence.
MOST_TERMS = 4096
# Most frequent terms of the sample whose pairs are all tested.
PAIR_TERMS = 4096

# Bytes that word beginnings have: forms of one word share some of them.
BEGINNINGS = (4, 5, 6, 7)


def _hashed(name: bytes) -> int:
    return xxhash.xxh32_intdigest(name) % TERM_SPACE


def _word_terms(word: bytes) -> tuple[int, ...]:
    """Hashed terms of a word: itself and its beginnings."""
    return tuple(_hashed(n) for n in (b"w" + word, *(b"p" + word[:n] for n in BEGINNINGS if len(word) > n)))


def _again(word: bytes) -> int:
    """Hashed term of a word that a text has twice or more."""
    return _hashed(b"2" + word)


def text_terms(text: bytes) -> set[int]:
    found: set[int] = set()
    for word, n in Counter(words_of(text)).items():
        found.update(_word_terms(word))
        if n > 1:
            found.add(_again(word))
    return found


class _Known(Memory):
    """Words to the numbers of their terms among the chosen ones: had once, and again."""

    def __init__(self, numbers: dict[int, int]):
        super().__init__(most=150_000)
        self.numbers = numbers

    def value(self, piece) -> tuple[tuple[int, ...], tuple[int, ...]]:
        once = tuple(self.numbers[t] for t in _word_terms(piece) if t in self.numbers)
        again = self.numbers.get(_again(piece))
        return once, once if again is None else (*once, again)


def present(known: _Known, text: bytes) -> list[int]:
    """Numbers of the chosen terms in a text, each once."""
    found: set[int] = set()
    for word, n in Counter(words_of(text)).items():
        found.update(known[word][n > 1])
    return sorted(found)


@dataclass(frozen=True)
class FactorizationMachine:
    """Logistic factorization machine over sets of terms.

    score = sigmoid(bias + sum of weights + sum over pairs of terms of the inner
    product of their factors).
    """

    terms: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, numbers: Sequence[int]) -> float:
        z = self.bias
        if len(numbers):
            v = self.factors[numbers]
            z += self.weights[numbers].sum() + 0.5 * (v.sum(axis=0) ** 2 - (v * v).sum(axis=0)).sum()
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def fit_machine(
    terms: np.ndarray, rows: Sequence[Sequence[int]], toxic: np.ndarray, importance: np.ndarray,
    factors: int = 8, epochs: int = 20, batch: int = 256, rate: float = 0.02,
    penalty: float = 1e-4, seed: int = 7,
) -> FactorizationMachine:
    """Fit by Adam on weighted log loss. ``rows``: numbers of the terms in each text."""
    rng = np.random.default_rng(seed)
    n_terms = len(terms)
    total = float(importance.sum())
    share = (float((importance * toxic).sum()) + 0.5) / (total + 1.0)
    # bias, weights and factors as one table: the last row is the bias in column 0.
    table = np.zeros((n_terms + 1, 1 + factors))
    table[:n_terms, 1:] = rng.normal(0, 0.05, (n_terms, factors))
    table[n_terms, 0] = np.log(share / (1 - share))
    first, second, step = np.zeros_like(table), np.zeros_like(table), 0
    sizes = np.array([len(r) for r in rows], dtype=np.int64)
    flat = np.concatenate([np.zeros(0, np.int64), *[np.asarray(r, np.int64) for r in rows]])
    starts = np.concatenate([[0], sizes.cumsum()])
    scale = importance / importance.mean() if len(importance) else importance
    for _ in range(epochs if len(rows) else 0):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            owner = np.repeat(np.arange(len(chosen)), sizes[chosen])
            shift = starts[chosen] - np.concatenate([[0], sizes[chosen].cumsum()[:-1]])
            cols = flat[np.arange(len(owner)) + np.repeat(shift, sizes[chosen])]
            held = table[cols]
            sums = np.zeros((len(chosen), 1 + factors))
            np.add.at(sums, owner, held)
            squares = np.zeros(len(chosen))
            np.add.at(squares, owner, (held[:, 1:] ** 2).sum(axis=1))
            z = table[n_terms, 0] + sums[:, 0] + 0.5 * ((sums[:, 1:] ** 2).sum(axis=1) - squares)
            error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - toxic[chosen]) * scale[chosen]
            error /= len(chosen)
            slope = np.zeros_like(table)
            own = np.empty_like(held)
            own[:, 0] = error[owner]
            own[:, 1:] = error[owner, None] * (sums[owner, 1:] - held[:, 1:])
            np.add.at(slope, cols, own)
            slope[:n_terms] += penalty * table[:n_terms]
            slope[n_terms, 0] = error.sum()
            step += 1
            first = 0.9 * first + 0.1 * slope
            second = 0.999 * second + 0.001 * slope**2
            table -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return FactorizationMachine(
        terms, float(table[n_terms, 0]), table[:n_terms, 0].copy(), table[:n_terms, 1:].copy()
    )


def _presence(rows: list[np.ndarray], low: int, high: int) -> np.ndarray:
    """Texts by the terms numbered ``low`` to ``high``, 1 where a text has the term."""
    held = np.zeros((len(rows), high - low), dtype=np.float32)
    for i, row in enumerate(rows):
        held[i, row[np.searchsorted(row, low) : np.searchsorted(row, high)] - low] = 1
    return held


def interacting(
    rows: list[np.ndarray], n_terms: int, error: np.ndarray, importance: np.ndarray,
    spread: float, least: float, block: int = 1024,
) -> np.ndarray:
    """Numbers of the terms that some other term makes matter.

    The score test of every pair: the errors a model leaves on the texts that have both
    terms, squared, over their variance were the pair to mean nothing (``spread`` a
    text). Either term of a pair at ``least`` or above is returned. Rows are sorted
    numbers; two blocks of columns are dense at a time.
    """
    found: set[int] = set()
    weighted = (error * importance)[:, None].astype(np.float32)
    square = (importance**2)[:, None].astype(np.float32)
    for left in range(0, n_terms, block):
        a = _presence(rows, left, min(left + block, n_terms))
        slope, size = (a * weighted).T, (a * square).T
        for right in range(left, n_terms, block):
            b = a if right == left else _presence(rows, right, min(right + block, n_terms))
            test = (slope @ b) ** 2 / np.maximum(spread * (size @ b), 1e-9)
            i, j = np.nonzero(test >= least)
            apart = (i + left) != (j + right)
            found.update((i[apart] + left).tolist(), (j[apart] + right).tolist())
    return np.array(sorted(found), dtype=np.int64)


def _sample(labels: DataFrame, doc_id: str, label: str, most: int) -> DataFrame:
    """(doc_id, toxic, importance) of at most ``most`` documents of either class.

    Picked by a hash of the id; ``importance`` is how many labelled documents of the
    class each stands for. A document with several labels is toxic if one says so.
    """
    known = (
        labels.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(label).alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    )
    sizes = dict(known.groupBy("toxic").count().collect())
    parts = []
    for kind in (0, 1):
        n = sizes.get(kind, 0)
        # The hash leaves a little more than needed, the limit the exact number.
        place = F.pmod(F.xxhash64(F.lit("sample"), F.col("doc_id")), F.lit(1 << 30))
        likely = int((1 << 30) * min(1.0, 1.2 * most / max(n, 1)))
        own = known.where((F.col("toxic") == kind) & (place <= likely)).orderBy(place, "doc_id")
        weight = max(1.0, n / most)
        parts.append(own.limit(most).withColumn("importance", F.lit(weight)))
    return reduce(DataFrame.unionAll, parts)


def _sample_terms(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(terms, toxic, importance) of the sampled documents; their texts are not moved.

    The sample is broadcast: its rows are bounded, three numbers each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [
                sorted(text_terms(text)) for text in texts_of(batch.column(0))
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.list_(pa.int32())), batch.column(1), batch.column(2)],
                ["terms", "toxic", "importance"],
            )

    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = ids.join(F.broadcast(sample), "doc_id").select("text", "toxic", "importance")
    return rows.mapInArrow(run, "terms array<int>, toxic int, importance double")


def _plogp(n: Column, of: Column) -> Column:
    return F.when(n > 0, n * F.log(n / of)).otherwise(0.0)


def train(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS,
    most_terms: int = MOST_TERMS, pair_terms: int = PAIR_TERMS, label: str = "toxic",
) -> FactorizationMachine:
    """Fit on a sample of labelled documents, ``sample_rows`` of either class at most.

    Terms are chosen in two ways. By their own evidence: the likelihood ratio of term and
    label, at most ``most_terms`` of those above 1.35 times the logarithm of the number
    of terms, which few reach by chance. And by their pairs: a machine over these terms
    leaves errors, and every pair of the ``pair_terms`` most frequent terms is tested
    against them (``interacting``), so two words that say nothing alone and much
    together are terms as well; then the machine is fitted over all of them. Only these
    terms of the sample come to the driver. Texts and labels join on doc_id; rows
    without a label, a null id or a null label teach nothing. Without any labels the
    model is the constant one half.
    """
    sample = materialized(_sample(labels, "doc_id", label, sample_rows), "labelled")
    rows = materialized(_sample_terms(docs, sample), "sample-terms")
    n = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    if not n["n"]:
        return fit_machine(np.zeros(0, np.int64), [], np.zeros(0), np.zeros(0))
    counts = rows.select(F.explode("terms").alias("term"), "toxic").groupBy("term").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("toxic").cast("double").alias("toxic")
    )
    counts = materialized(counts, "term-counts")
    least = 1.35 * float(np.log(max(counts.count(), 1)))
    both, bad = F.lit(float(n["n"])), F.lit(float(n["toxic"]))
    here, gone = F.col("n"), both - F.col("n")
    evidence = 2 * (
        _plogp(F.col("toxic"), here * bad / both)
        + _plogp(here - F.col("toxic"), here * (both - bad) / both)
        + _plogp(bad - F.col("toxic"), gone * bad / both)
        + _plogp(gone - bad + F.col("toxic"), gone * (both - bad) / both)
    )
    chosen = (
        counts.select("term", evidence.alias("evidence"))
        .where(F.col("evidence") >= least)
        .orderBy(F.desc("evidence"), "term")
        .limit(most_terms)
    )
    own = {r["term"] for r in chosen.collect()}
    often = counts.where("n >= 2").orderBy(F.desc("n"), "term").limit(pair_terms)
    terms = np.array(sorted(own.union(r["term"] for r in often.collect())), dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = {int(t): i for i, t in enumerate(terms)}
        for batch in batches:
            kept = [[numbers[t] for t in row if t in numbers] for row in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(kept, pa.list_(pa.int32())), batch.column(1), batch.column(2)],
                ["terms", "toxic", "importance"],
            )

    kept = rows.mapInArrow(run, rows.schema).toArrow()
    held = [r.values.to_numpy() for r in kept["terms"]]
    toxic, importance = (kept[c].to_numpy().astype(float) for c in ("toxic", "importance"))
    # In an order of their own, so that the fit does not depend on which task came first.
    order = sorted(range(len(held)), key=lambda i: (toxic[i], held[i].tobytes()))
    held, toxic, importance = [held[i] for i in order], toxic[order], importance[order]

    def fitted(numbers: np.ndarray) -> tuple[FactorizationMachine, list[np.ndarray]]:
        place = np.full(len(terms), -1)
        place[numbers] = np.arange(len(numbers))
        chosen_rows = [p[p >= 0] for p in (place[r] for r in held)]
        return fit_machine(terms[numbers], chosen_rows, toxic, importance), chosen_rows

    alone = np.flatnonzero([int(t) in own for t in terms])
    machine, alone_rows = fitted(alone)
    error = toxic - np.array([machine.score(r) for r in alone_rows])
    share = float((importance * toxic).sum() / importance.sum())
    # Pairs are many more than terms, so they must reach as much more.
    pairs = max(len(terms) * (len(terms) - 1) / 2, 2)
    least_pair = 2 * 1.35 * float(np.log(pairs))
    paired = interacting(held, len(terms), error, importance, share * (1 - share), least_pair)
    both_ways = np.union1d(alone, paired)
    return machine if len(both_ways) == len(alone) else fitted(both_ways)[0]


def score(docs: DataFrame, machine: FactorizationMachine) -> DataFrame:
    """Every row of ``docs`` as ``row`` (a struct of all its columns), with ``score``.

    Only ``text`` is looked at, the whole of it; nothing is shuffled. Null and empty
    texts get the model's constant. Repeated rows come out as often, no rows give none.
    """
    numbers = {int(t): i for i, t in enumerate(machine.terms)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(numbers)
        for batch in batches:
            scores = [machine.score(present(known, t)) for t in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], ["row", "score"]
            )

    columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(columns, "text")
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, score double")

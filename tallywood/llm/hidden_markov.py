"""A hidden Markov language model whose parameters are counted over a whole corpus."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywood.llm.frames import texts_of
from tallywood.plans.scratch import materialized

STATES = 8
# States emit one of this many word classes; a class emits its words. The parameters
# that tasks hold have a fixed size, while every word keeps a count of its own.
CLASSES = 1 << 15
ROUNDS = 5
# Long documents are trained on in windows of so many tokens, scored whole.
WINDOW = 512
# Bytes of text that are encoded into one block.
BLOCK_BYTES = 8 << 20
# Tokens that a class counts for the corpus frequencies where a state has emitted it.
KINDS_WEIGHT = 2.0
# Training tokens a word is taken to have more than it has.
ADDED = 0.5


def _hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 42)


def tokens_of(text: bytes) -> list[bytes]:
    """Words at ASCII white space, A-Z lower-cased, and the end token: no bytes."""
    return [*text.lower().split(), b""]


BLOCK = pa.schema([
    ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
    ("lengths", pa.list_(pa.int64())), ("tokens", pa.binary()), ("classes", pa.binary()),
    ("hashes", pa.binary()), ("counts", pa.binary()),
])
BLOCK_SQL = (
    "block bigint, doc_ids array<bigint>, held array<boolean>, lengths array<bigint>, "
    "tokens binary, classes binary, hashes binary, counts binary"
)


def _packed(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, low bytes first, then the next bytes, ..., compressed."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(data: bytes, n: int) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data, max_output_size=max(4 * n, 1))
    planes = np.frombuffer(raw, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def encoded(docs: DataFrame, held_out: Column, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents in blocks of about ``block_bytes`` of text, one row each, unshuffled.

    A block has its own small dictionary: ``tokens`` number its words, ``hashes``,
    ``classes`` and ``counts`` (in training documents) are by that number.
    """

    def block(number: int, ids: list, held: list, texts: list[bytes]) -> dict:
        own: dict[bytes, int] = {}
        known: list[np.ndarray] = []
        for text in texts:
            words = tokens_of(text)
            known.append(np.array([own.setdefault(w, len(own)) for w in words], dtype=np.uint32))
        lengths = [len(k) for k in known]
        flat = np.concatenate(known)
        in_training = np.repeat(~np.array(held, dtype=bool), lengths)
        counts = np.bincount(flat[in_training], minlength=len(own))
        hashes = np.array([_hash(w) for w in own], dtype="<u8")
        return {
            "block": number, "doc_ids": ids, "held": held, "lengths": lengths,
            "tokens": _packed(flat), "hashes": hashes.tobytes(), "counts": _packed(counts),
            "classes": (hashes % CLASSES).astype("<u2").tobytes(),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, held, texts, size = [], [], [], 0
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch.column(2)))
            for doc_id, out, text in rows:
                if size and size + len(text) > block_bytes:
                    yield pa.RecordBatch.from_pylist([block(number, ids, held, texts)], BLOCK)
                    number += 1
                    ids, held, texts, size = [], [], [], 0
                ids.append(doc_id)
                held.append(out)
                texts.append(text)
                size += len(text) + 1
        if texts:
            yield pa.RecordBatch.from_pylist([block(number, ids, held, texts)], BLOCK)

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held"), "text",
    )
    return rows.mapInArrow(run, BLOCK_SQL)


def _dictionary_rows(blocks: DataFrame) -> DataFrame:
    """(word, block, entry, n): each word of a block's dictionary by its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, hashes, counts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                word = np.frombuffer(hashes, "<i8")
                n = _unpacked(counts, len(word)).astype(np.int64)
                for at in range(0, len(word), 1 << 16):
                    to = min(at + (1 << 16), len(word))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(word[at:to]), pa.array(np.full(to - at, block)),
                            pa.array(np.arange(at, to, dtype=np.int32)), pa.array(n[at:to]),
                        ],
                        ["word", "block", "entry", "n"],
                    )

    return blocks.select("block", "hashes", "counts").mapInArrow(
        run, "word bigint, block bigint, entry int, n bigint"
    )


def _corpus_counts(blocks: DataFrame) -> DataFrame:
    """What the corpus says of the words, in two kinds of rows.

    Of a block: ``entries`` and their corpus-wide ``counts``, in several parts. Of a
    class: ``n`` training tokens and ``kinds`` known words, in several parts. Words are
    counted by a sum over equal hashes of 64 bits; a word has one row a block at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, block, entry, n, total, first = (
                batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)
            )
            order = np.argsort(block, kind="stable")
            blocks_, starts = np.unique(block[order], return_index=True)
            ends = [*starts[1:], len(order)]
            rows = [
                {
                    "block": int(b), "entries": entry[order[s:e]].astype("<u4").tobytes(),
                    "counts": total[order[s:e]].astype("<i8").tobytes(),
                }
                for b, s, e in zip(blocks_, starts, ends)
            ]
            own = (word.view(np.uint64) % CLASSES).astype(np.int64)
            classes, at = np.unique(own, return_inverse=True)
            sums = np.bincount(at, n).astype(np.int64)
            kinds = np.bincount(at, (first == block) & (total > 0)).astype(np.int64)
            rows += [
                {"class": int(c), "n": int(s), "kinds": int(k)}
                for c, s, k in zip(classes, sums, kinds) if s or k
            ]
            yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([
        ("block", pa.int64()), ("entries", pa.binary()), ("counts", pa.binary()),
        ("class", pa.int32()), ("n", pa.int64()), ("kinds", pa.int64()),
    ])
    same = Window.partitionBy("word")
    rows = _dictionary_rows(blocks).select(
        "word", "block", "entry", "n", F.sum("n").over(same).alias("total"),
        F.min("block").over(same).alias("first"),
    )
    return rows.mapInArrow(
        run, "block bigint, entries binary, counts binary, class int, n bigint, kinds bigint"
    )


@dataclass
class HiddenMarkov:
    """Start, transition and emission (class by state) probabilities; training counts.

    A text's probability: the states' sequence of classes, times that of each word in
    its class, (count + ADDED) / (class_tokens + ADDED (class_kinds + 1)); one place
    of a class is that of all its unknown words.
    """

    start: np.ndarray
    moves: np.ndarray
    emits: np.ndarray
    class_tokens: np.ndarray
    class_kinds: np.ndarray

    @property
    def tokens(self) -> int:
        return int(self.class_tokens.sum())

    @property
    def kinds(self) -> int:
        return int(self.class_kinds.sum())

    def in_class(self) -> np.ndarray:
        """log10 of the denominators of the words of each class."""
        return np.log10(self.class_tokens + ADDED * (self.class_kinds + 1))


def initial(class_tokens: np.ndarray, class_kinds: np.ndarray, states: int, seed: int = 11) -> HiddenMarkov:
    """Class frequencies, bent at random for each state, and states that like to stay."""
    rng = np.random.default_rng(seed)
    emits = _prior(class_tokens, class_kinds)[:, None] * np.exp(rng.normal(0, 0.7, (CLASSES, states)))
    moves = np.full((states, states), 0.05 / max(states - 1, 1))
    np.fill_diagonal(moves, 0.95 if states > 1 else 1.0)
    return HiddenMarkov(
        np.full(states, 1 / states), moves, emits / emits.sum(axis=0), class_tokens, class_kinds
    )


def _prior(class_tokens: np.ndarray, class_kinds: np.ndarray) -> np.ndarray:
    weight = class_tokens + ADDED * (class_kinds + 1)
    return weight / weight.sum()


def _steps(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequences from the longest on, and how many of them reach each step."""
    order = np.argsort(-lengths, kind="stable")
    reach = np.bincount(lengths, minlength=1)
    active = len(lengths) - np.cumsum(reach)[:-1] if len(reach) > 1 else np.zeros(0, np.int64)
    return order, active


def forward(classes: np.ndarray, lengths: np.ndarray, model: HiddenMarkov) -> np.ndarray:
    """log10 likelihood of each class sequence, by the scaled forward recursion."""
    lengths = np.asarray(lengths, dtype=np.int64)
    starts = np.concatenate([[0], lengths.cumsum()[:-1]]).astype(np.int64)
    order, active = _steps(lengths)
    at = starts[order]
    found = np.zeros(len(lengths))
    ones = np.ones(len(model.start))
    state = np.broadcast_to(model.start, (len(lengths), len(ones)))
    for t, n in enumerate(active):
        state = (state[:n] if not t else state[:n] @ model.moves) * model.emits[classes[at[:n] + t]]
        scale = state @ ones
        state /= scale[:, None]
        found[:n] += np.log10(scale)
    out = np.empty(len(lengths))
    out[order] = found
    return out


@dataclass
class Counts:
    """Expected counts of one round of Baum-Welch."""

    start: np.ndarray
    moves: np.ndarray
    emits: np.ndarray

    @classmethod
    def zero(cls, states: int) -> Counts:
        return cls(np.zeros(states), np.zeros((states, states)), np.zeros((CLASSES, states)))


def expect(classes: np.ndarray, lengths: np.ndarray, model: HiddenMarkov, into: Counts) -> None:
    """Add the expected counts of some sequences, by scaled forward and backward."""
    lengths = np.asarray(lengths, dtype=np.int64)
    starts = np.concatenate([[0], lengths.cumsum()[:-1]]).astype(np.int64)
    order, active = _steps(lengths)
    at = starts[order]
    kind = np.float32
    moves, emits, ones = model.moves.astype(kind), model.emits.astype(kind), np.ones(len(model.start), kind)
    state = np.broadcast_to(model.start.astype(kind), (len(lengths), len(ones)))
    seen, states, emitted, scales = [], [], [], []
    for t, n in enumerate(active):
        own = classes[at[:n] + t]
        e = emits[own]
        state = (state[:n] if not t else state[:n] @ moves) * e
        scale = state @ ones
        state /= scale[:, None]
        seen.append(own)
        states.append(state)
        emitted.append(e)
        scales.append(scale)
    pair = np.zeros_like(into.moves)
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        later = active[t + 1] if t + 1 < len(active) else 0
        back = np.ones((n, len(ones)), kind)
        if later:
            ahead = emitted[t + 1] * after
            ahead /= scales[t + 1][:, None]
            pair += states[t][:later].T @ ahead
            back[:later] = ahead @ moves.T
        after = back
        states[t] = states[t] * back  # posterior; the forward state is not needed again
    if len(active):
        into.start += states[0].sum(axis=0)
        into.moves += pair * model.moves
        own, posterior = np.concatenate(seen), np.concatenate(states)
        for s in range(len(ones)):
            into.emits[:, s] += np.bincount(own, posterior[:, s], minlength=CLASSES)


def _windows(lengths: np.ndarray, most: int) -> np.ndarray:
    """Lengths of the windows that sequences are cut into, in their order."""
    whole, rest = np.divmod(lengths, most)
    parts = np.repeat(np.full(len(lengths), most), whole + 1)
    parts[(whole + 1).cumsum() - 1] = rest
    return parts[parts > 0]


def _round(blocks: DataFrame, model: HiddenMarkov) -> Counts:
    """Expected counts of all training documents: summed in each task, then by class."""
    states = len(model.start)
    names = [f"s{i}" for i in range(states)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts.zero(states)
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], dtype=np.int64)
                own = np.frombuffer(row["classes"], "<u2")
                tokens = own[_unpacked(row["tokens"], int(lengths.sum()))]
                training = ~np.array(row["held"], dtype=bool)
                tokens = tokens[np.repeat(training, lengths)]
                expect(tokens, _windows(lengths[training], WINDOW), model, counts)
        used = np.flatnonzero(counts.emits.sum(axis=1) > 0)
        # Negative classes: moves from each state, then the starts.
        table = np.concatenate([counts.moves, counts.start[None], counts.emits[used]])
        index = np.concatenate([-1 - np.arange(states + 1), used]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(index), *map(pa.array, table.T.astype(np.float64).copy())], ["class", *names]
        )

    rows = blocks.select("held", "lengths", "tokens", "classes").mapInArrow(
        run, "class int, " + ", ".join(f"{n} double" for n in names)
    )
    total = rows.groupBy("class").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    index = total.column("class").to_numpy()
    values = np.stack([total.column(n).to_numpy() for n in names], axis=1)
    counts = Counts.zero(states)
    counts.emits[index[index >= 0]] = values[index >= 0]
    low = index < 0
    rest = np.zeros((states + 1, states))
    rest[-1 - index[low]] = values[low]
    counts.moves, counts.start = rest[:states], rest[states]
    return counts


def improved(model: HiddenMarkov, counts: Counts) -> HiddenMarkov:
    """The most likely parameters for expected counts, smoothed."""
    start = counts.start + 0.1
    moves = counts.moves + 0.1
    # The more different classes a state has emitted, the more it trusts their frequencies
    # in the whole corpus, as Witten and Bell do.
    kinds = np.minimum(counts.emits, 1).sum(axis=0) + 1
    emits = counts.emits + KINDS_WEIGHT * kinds * _prior(model.class_tokens, model.class_kinds)[:, None]
    return HiddenMarkov(
        start / start.sum(), moves / moves.sum(axis=1, keepdims=True),
        emits / emits.sum(axis=0), model.class_tokens, model.class_kinds,
    )


def train(blocks: DataFrame, corpus: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> HiddenMarkov:
    """Baum-Welch over all training documents of ``blocks``.

    What comes to the driver in a round are the summed counts of CLASSES x states,
    a fixed size; the tasks get the parameters, of the same size.
    """
    stats = (
        corpus.where("class IS NOT NULL").groupBy("class")
        .agg(F.sum("n").alias("n"), F.sum("kinds").alias("kinds")).collect()
    )
    tokens, kinds = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in stats:
        tokens[r["class"]], kinds[r["class"]] = r["n"], r["kinds"]
    model = initial(tokens, kinds, states)
    for _ in range(rounds):
        model = improved(model, _round(blocks, model))
    return model


def score(blocks: DataFrame, corpus: DataFrame, model: HiddenMarkov) -> DataFrame:
    """Scores of every document, as described at ``hidden_markov_scores``."""
    parts = (
        corpus.where("block IS NOT NULL").groupBy("block")
        .agg(F.collect_list(F.struct("entries", "counts")).alias("parts"))
    )
    base_below = float(np.log10(model.tokens + ADDED * (model.kinds + 1)))
    train_tokens = model.tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        below = model.in_class()
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], dtype=np.int64)
                entries = _unpacked(row["tokens"], int(lengths.sum()))
                classes = np.frombuffer(row["classes"], "<u2")
                counts = np.zeros(len(classes), np.int64)
                for part in row["parts"]:
                    counts[np.frombuffer(part["entries"], "<u4")] = np.frombuffer(part["counts"], "<i8")
                above = np.log10(counts + ADDED)
                starts = np.concatenate([[0], lengths.cumsum()[:-1]])
                total = lambda values: np.add.reduceat(values[entries], starts)  # noqa: E731,B023
                in_base = total(above)
                scores = forward(classes[entries], lengths, model) + total(above - below[classes])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()), pa.array(row["held"], pa.bool_()),
                        pa.array(lengths), pa.array(total((counts > 0).astype(np.int64))),
                        pa.array(np.full(len(lengths), train_tokens)),
                        pa.array(in_base - lengths * base_below), pa.array(scores),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    own = blocks.select("block", "doc_ids", "held", "lengths", "tokens", "classes")
    return own.join(parts, "block").mapInArrow(
        run,
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double",
    )


def hidden_markov_scores(
    docs: DataFrame, held_out: Column, states: int = STATES, rounds: int = ROUNDS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Train on the rows of ``docs`` (doc_id, text) not ``held_out`` and score all of them.

    doc_id, held_out, n_tokens (with one end token each), n_known (seen in training),
    train_tokens, base_score (sum of log10 (count + 0.5) / (tokens + 0.5 (kinds + 1))),
    score: log10 of the text's exact probability in the model, over its whole length.

    Texts are encoded once into blocks in the shared folder. Each block's words meet
    the words of all other blocks in one shuffle, one row for each word and block, and
    come back with their corpus-wide counts; this grows with the corpus and nothing of
    it is collected. Baum-Welch then reads the blocks once a round.

    Null text: empty, the end token alone. A null id is not held out unless the given
    condition says so. Repeated rows count and come out as often; other columns are
    ignored; without training rows the model knows no word; no rows give no rows.
    """
    blocks = materialized(encoded(docs, held_out, block_bytes), "blocks")
    corpus = materialized(_corpus_counts(blocks), "corpus")
    return score(blocks, corpus, train(blocks, corpus, states, rounds))

"""Licence notices and identifier tags in texts, by Aho-Corasick."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.llm.decontaminate import words_of
from tallywood.llm.frames import texts_of

# The base phrases with their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further notice phrases, and what licence identifiers begin with.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "boost",
    "creative commons attribution": "cc-by",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "bsd license": "bsd",
    "isc license": "isc",
    "all rights reserved": "reserved",
}
FAMILIES = {
    "gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl", "apache": "apache", "mit": "mit", "bsd": "bsd",
    "isc": "isc", "mpl": "mpl", "epl": "epl", "bsl": "boost", "cc-by-nc": "cc-by-nc",
    "cc-by-sa": "cc-by-sa", "cc-by-nd": "cc-by-nd", "cc-by": "cc-by", "cc0": "cc0",
    "unlicense": "unlicense",
}
PERMISSIVE = ("apache", "boost", "bsd", "cc-by", "cc0", "isc", "mit", "unlicense")
TAGS = ("spdx-license-identifier:", "license-expression:")

# How sure one find of a kind is: a tag that parses, a base phrase, a further notice.
SURE = {"tag": 0.9, "base": 0.6, "notice": 0.4}

_TOKEN = re.compile(r"[()]|[a-z0-9][a-z0-9.+:-]*")
_NEXT = re.compile(r"[ \t]*([()]|[a-z0-9][a-z0-9.+:-]*)")
_UNKNOWN = re.compile(r"licenseref-[a-z0-9.-]+|[a-z0-9]+(-[a-z0-9.]+)*-\d+(\.\d+)*(-only|-or-later)?\+?")
_LINE_END = re.compile(r"[\r\n]")
_RANK = {"or": 1, "and": 2, "with": 3}


def family(identifier: str) -> str:
    """Label of a licence identifier: its family, or itself if that is not known."""
    parts = identifier.rstrip("+").split("-")
    for n in range(len(parts), 0, -1):
        if (found := FAMILIES.get("-".join(parts[:n]))) is not None:
            return found
    return identifier


def postfix(expression: str) -> list[str] | None:
    """Tokens of a lower-case licence expression in postfix order, by shunting-yard.

    ``with`` binds closer than ``and``, that closer than ``or``. None if it is not an
    expression: operands or operators missing, unbalanced brackets, other characters.
    """
    if _TOKEN.sub("", expression).strip():
        return None
    output: list[str] = []
    waiting: list[str] = []
    operand_next = True
    for token in _TOKEN.findall(expression):
        if operand_next == (token in _RANK or token == ")"):
            return None
        if token == "(":
            waiting.append(token)
        elif token == ")":
            while waiting and waiting[-1] != "(":
                output.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        elif token in _RANK:
            while waiting and _RANK.get(waiting[-1], 0) >= _RANK[token]:
                output.append(waiting.pop())
            waiting.append(token)
            operand_next = True
        else:
            output.append(token)
            operand_next = False
    if operand_next or "(" in waiting:
        return None
    return output + waiting[::-1]


def evaluate(tokens: list[str], allowed: frozenset[str]) -> tuple[bool, set[str]]:
    """Whether a postfix expression can be met by allowed families, and its labels.

    ``or`` takes either side, ``and`` needs both; an exception after ``with`` only adds
    rights, so its licence decides.
    """
    stack: list[tuple[bool, set[str]]] = []
    for token in tokens:
        if token not in _RANK:
            stack.append((family(token) in allowed, {family(token)}))
            continue
        (right, more), (left, labels) = stack.pop(), stack.pop()
        if token == "with":
            stack.append((left, labels))
        else:
            stack.append((left or right if token == "or" else left and right, labels | more))
    return stack[0]


def is_identifier(name: str) -> bool:
    """Whether a token names a licence: one of a known family, a reference, or any name that
    ends with a version, as SPDX identifiers do."""
    return family(name) in FAMILIES.values() or _UNKNOWN.fullmatch(name) is not None


def _leading(line: str) -> list[str] | None:
    """The longest beginning of a line that is an expression, in postfix order.

    A tag may be followed by other text, such as the end of a comment: the first character
    that belongs to no token, or word that names no licence, ends the expression; so does
    an operator without an operand after it. One pass finds the last operand or bracket
    up to which the tokens are an expression.
    """
    tokens: list[str] = []
    depth = whole = at = 0
    operand_next = True
    while (found := _NEXT.match(line, at)) is not None:
        token, at = found[1], found.end()
        if operand_next == (token in _RANK or token == ")"):
            break
        if token == "(":
            depth += 1
        elif token == ")":
            depth -= 1
            if depth < 0:
                break
        elif token in _RANK:
            operand_next = True
        else:
            bare = token.rstrip(".:")
            if not (tokens and tokens[-1] == "with") and not is_identifier(bare):
                break
            operand_next = False
            if bare != token:  # a full stop ends the sentence
                token, at = bare, len(line)
        tokens.append(token)
        if not depth and not operand_next:
            whole = len(tokens)
    return postfix(" ".join(tokens[:whole]))


@cache
def _phrases() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase, label in {**NOTICES, **BASE}.items():
        found.add_word(f" {phrase} ", (phrase, label))
    found.make_automaton()
    return found


@cache
def _tags() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for tag in TAGS:
        found.add_word(tag, tag)
    found.make_automaton()
    return found


_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def scan_text(text: bytes, allowed: frozenset[str]) -> tuple:
    """n_words, n_base, first_word, last_word, base labels, labels, score, expressions."""
    words = words_of(text)
    line = f" {b' '.join(words).decode(errors='replace')} "
    finds = list(_phrases().iter(line))
    base_places: list[int] = []
    base: set[str] = set()
    labels: set[str] = set()
    doubt = 1.0
    if finds:
        blanks = np.flatnonzero(np.frombuffer(line.encode("utf-32-le"), np.uint32) == 32)
        for end, (phrase, label) in finds:
            labels.add(label)
            doubt *= 1 - SURE["base" if phrase in BASE else "notice"]
            if phrase in BASE:
                base.add(label)
                base_places.append(int(np.searchsorted(blanks, end)) - phrase.count(" ") - 1)
    expressions = []
    raw = text.decode(errors="replace").translate(_LOWER)
    for end, _ in _tags().iter(raw):
        stop = _LINE_END.search(raw, end)  # a tag's expression ends with its line
        tail = raw[end + 1 : stop.start() if stop else len(raw)]
        tokens = _leading(tail)
        if tokens is None:
            expressions.append((tail.strip(), False, False))
            continue
        usable, own = evaluate(tokens, allowed)
        labels |= own
        doubt *= 1 - SURE["tag"]
        expressions.append((tail.strip(), True, usable))
    return (
        len(words), len(base_places), min(base_places, default=None),
        max(base_places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)),
        1 - doubt, expressions,
    )


_ADDED = {
    "n_words": ("bigint", pa.int64()),
    "n_base": ("bigint", pa.int64()),
    "first_word": ("bigint", pa.int64()),
    "last_word": ("bigint", pa.int64()),
    "base_labels": ("string", pa.string()),
    "labels": ("string", pa.string()),
    "score": ("double", pa.float64()),
    "expressions": (
        "array<struct<text: string, valid: boolean, usable: boolean>>",
        pa.list_(pa.struct([("text", pa.string()), ("valid", pa.bool_()), ("usable", pa.bool_())])),
    ),
}


def scan(docs: DataFrame, allowed: tuple[str, ...] = PERMISSIVE) -> DataFrame:
    """Every row of ``docs`` as ``row`` (a struct of all its columns), with what it says.

    n_words; n_base, first_word, last_word, base_labels: places of the base phrases as
    consecutive words, their smallest and largest start (null without) and labels;
    labels: also those of further notices and of tagged licence expressions; score: how
    sure some licence is stated, 0 without any find; expressions: each tag's text,
    whether its beginning is an expression, and whether families in ``allowed`` meet it.
    Labels are distinct, sorted and comma-joined; empty if there are none.

    Two automata pass over each whole text; nothing is shuffled. Null text: no words.
    Other columns are not looked at; repeated rows come out as often; no rows give none.
    """
    usable = frozenset(allowed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan_text(t, usable) for t in texts_of(batch.column(1))]
            columns = list(zip(*found)) or [()] * len(_ADDED)
            named = [
                [dict(zip(("text", "valid", "usable"), e)) for e in row] for row in columns[-1]
            ]
            arrays = [
                pa.array(c, kind)
                for c, (_, kind) in zip([*columns[:-1], named], _ADDED.values())
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["row", *_ADDED])

    columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(columns, "text")
    added = ", ".join(f"{name} {kind}" for name, (kind, _) in _ADDED.items())
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, {added}")

from __future__ import annotations

import itertools
import random
import re

import pytest

from tallywood.llm import licences
from tallywood.llm.queries import QUERIES

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    starts, labels = [], set()
    for phrase, label in licences.BASE.items():
        own = phrase.split()
        for i in range(len(words) - len(own) + 1):
            if words[i : i + len(own)] == own:
                starts.append(i)
                labels.add(label)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(labels)))


def test_query(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    found = {r.doc_id: r for r in QUERIES["op10_licence_scan"](spark, folder).collect()}
    assert len(found) == len(docs)
    for d in docs:
        r = found[d.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(d.text)
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert (r.score > 0) == bool(r.labels) and 0 <= r.score <= 1
    assert any(r.n_base for r in found.values())


def test_places_match_brute_force(spark):
    rng = random.Random(2)
    some = ["gnu", "general", "public", "license", "apache", "cc", "by", "mit", "été", "BY"]
    docs = [(i, "".join(rng.choice(some) + rng.choice([" ", "-", "\n"]) for _ in range(30)), 0) for i in range(60)]
    docs += [(None, None, 0), (70, "", 0), (71, "mit license " * 40_000, 0), (70, "", 0)]
    frame = spark.createDataFrame(docs, "doc_id int, text string, labels int")
    found = licences.scan(frame).collect()
    assert len(found) == len(docs)
    for r in found:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(r.row.text)
    assert licences.scan(frame.limit(0)).count() == 0


def by_descent(tokens, allowed):
    """Another way to evaluate: precedence climbing on the tokens."""
    def level(at, rank):
        if rank == 4:
            if tokens[at] == "(":
                value, at = level(at + 1, 1)
                return value, at + 1
            return licences.family(tokens[at]) in allowed, at + 1
        name = {1: "or", 2: "and", 3: "with"}[rank]
        value, at = level(at, rank + 1)
        while at < len(tokens) and tokens[at] == name:
            right, at = level(at + 1, rank + 1)
            value = {"or": value or right, "and": value and right, "with": value}[name]
        return value, at
    return level(0, 1)[0]


def test_expressions_evaluate_by_precedence():
    allowed = frozenset(licences.PERMISSIVE)
    names = ["mit", "gpl-3.0-only", "apache-2.0"]
    for ops in itertools.product(["or", "and", "with"], repeat=2):
        for ids in itertools.product(names, repeat=3):
            for shape in ("{} {} {} {} {}", "( {} {} {} ) {} {}", "{} {} ( {} {} {} )"):
                text = shape.format(ids[0], ops[0], ids[1], ops[1], ids[2])
                tokens = licences.postfix(text)
                assert licences.evaluate(tokens, allowed)[0] == by_descent(text.split(), allowed)


@pytest.mark.parametrize("bad", ["", "or", "mit or", "and mit", "mit mit", "(mit", "mit)", "()", "mit & x"])
def test_what_is_no_expression(bad):
    assert licences.postfix(bad) is None


def test_tags():
    found = licences.scan_text(
        b"// SPDX-License-Identifier: (MIT OR GPL-2.0+) AND BSD-3-Clause */\nx", frozenset({"mit", "bsd"})
    )
    assert found[5] == "bsd,gpl,mit" and found[4] == "" and found[6] == pytest.approx(0.9)
    assert found[7] == [("(mit or gpl-2.0+) and bsd-3-clause */", True, True)]
    found = licences.scan_text(b"SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0", frozenset({"mit"}))
    assert found[5] == "gpl" and found[7][0][1:] == (True, False)
    found = licences.scan_text(b"spdx-license-identifier: ???\nCC BY-NC 4.0", frozenset())
    assert found[5] == "cc-by,cc-by-nc" and found[7] == [("???", False, False)]


def test_long_expressions_are_read_whole():
    ids = [f"licenseref-some-long-name-{i}" for i in range(80)]
    line = " AND ".join([*ids, "GPL-3.0-only"])
    for text in (line, f"({line})", f"({line}) */ more", f"{line} and"):
        found = licences.scan_text(f"SPDX-License-Identifier: {text}\nx".encode(), frozenset(ids))
        assert set(found[5].split(",")) == {*ids, "gpl"} and found[7][0][1:] == (True, False)


def test_leading_expression_is_the_longest_that_parses():
    rng = random.Random(5)
    for _ in range(3000):
        tokens = rng.choices(["mit", "isc", "and", "or", "with", "(", ")"], k=rng.randint(0, 9))
        whole = (licences.postfix(" ".join(tokens[:n])) for n in range(len(tokens), 0, -1))
        assert licences._leading(" ".join(tokens)) == next((p for p in whole if p is not None), None)


@pytest.mark.parametrize("line,labels,usable", [
    ("MIT.", "mit", True), ("MIT, or so", "mit", True), ("MIT*/ or x", "mit", True),
    ("see LICENSE file", "", None), ("MIT AND", "mit", True), ("MIT\rand GPL-2.0", "mit", True),
    ("MIT or so", "mit", True), ("GPL-2.0-only WITH Classpath-exception-2.0 */", "gpl", False),
    ("Zlib-1.2 or MIT", "mit,zlib-1.2", True), ("LicenseRef-Own", "licenseref-own", False),
    ("(MIT or GPL-2.0).", "gpl,mit", True), ("Apache-2.0: text", "apache", True),
])
def test_where_an_expression_ends(line, labels, usable):
    *_, found, score, expressions = licences.scan_text(
        f"SPDX-License-Identifier: {line}\nnext".encode(), frozenset(licences.PERMISSIVE)
    )
    assert found == labels and (score > 0) == bool(labels)
    assert [e[2] for e in expressions if e[1]] == ([] if usable is None else [usable])

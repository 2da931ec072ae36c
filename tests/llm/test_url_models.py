from __future__ import annotations

import math
from collections import Counter, defaultdict

from tallywood.llm import url_models
from tallywood.llm.queries import QUERIES, URL_RULES


def test_query(same_as_sql):
    same_as_sql("op2_url_language_models")


def plain_split(url):
    url = url or ""
    if "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    for mark in "?#":
        rest = rest.split(mark, 1)[0]
    host, slash, path = rest.partition("/")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + path


def test_rules_and_odd_rows(spark, capsys):
    urls = {
        "http://WWW.Example.com/en/x": "allow", "http://a.example.com/en/x": "block",
        "http://example.com/EN/x": "allow", "https://notcom/": None, "http://com/": "allow",
        "http://com": None, "http://a.net/es/": "block", "http://a.net/fr/1?q=/en/": "block",
        "http://a.net?x=/es/": None, "ftp://x.y://z.com/a": None, None: None, "": None,
        "a.com/b": None, "http://é.net/fr/\nx": "block", "http://b.org/" + "x" * 100_000: None,
    }
    rows = [(i, u, "c") for i, u in enumerate(urls)] + [(None, "http://a.com/é", "c"), (2, "http://example.com/EN/x", "c")]
    frame = spark.createDataFrame(rows, "page_id int, url string, host string")
    found = url_models.judge(frame, URL_RULES).collect()
    assert len(found) == len(rows)
    by = {r.page_id: r for r in found}
    for i, (url, verdict) in enumerate(urls.items()):
        assert (by[i].host, by[i].path) == plain_split(url)
        assert by[i].verdict in ("allow", "block")
        assert (by[i].rule is not None) == (verdict is not None)
        assert verdict is None or by[i].verdict == verdict
    assert by[0].rule == "www.example.com/en/" and by[1].rule == "example.com/en/"
    assert url_models.judge(frame.limit(0), URL_RULES).count() == 0
    assert {r.verdict for r in url_models.judge(frame, []).collect()} == {"allow"}


def test_weights_are_witten_bell(spark):
    texts = {"accepted": ["^^^abc^", "^^^abd^"], "rejected": ["^^^xbc^"]}
    counts = {k: Counter(t[i : i + 4] for t in ts for i in range(len(t) - 3)) for k, ts in texts.items()}
    every = sorted(set(counts["accepted"]) | set(counts["rejected"]) | {"zzzz", "^abx"})
    frame = spark.createDataFrame(
        [(g, counts["accepted"][g], counts["rejected"][g]) for g in every],
        "gram string, accepted bigint, rejected bigint",
    )

    def p(kind, gram):
        value = 1 / 32
        for k in range(4):
            follow = defaultdict(int)
            for g, n in counts[kind].items():
                if g[3 - k : 3] == gram[3 - k : 3]:
                    follow[g[3]] += n
            total, kinds = sum(follow.values()), len(follow)
            if total:
                value = (follow[gram[3]] + kinds * value) / (total + kinds)
        return value

    for r in url_models.gram_weights(frame).collect():
        expected = math.log(p("accepted", r.gram)) - math.log(p("rejected", r.gram))
        assert abs(r.weight - 1e6 * expected) <= 1


def test_models_tell_kinds_apart(spark):
    rows = [(i, f"http://site{i}.com/news/{i}.html") for i in range(80)]
    rows += [(100 + i, f"http://cheap-pills{i}.net/es/buy-now/{i}") for i in range(80)]
    rows += [(300, "http://cheap-pills7.org/buy-now/3"), (301, "http://site5.org/news/5.html")]
    found = {r.page_id: r for r in url_models.judge(
        spark.createDataFrame(rows, "page_id int, url string"), URL_RULES).collect()}
    assert found[300].verdict == "block" and found[301].verdict == "allow"


def test_no_python_on_the_executors(spark, folder, plan_text):
    assert "Python" not in plan_text(QUERIES["op2_url_language_models"](spark, folder))

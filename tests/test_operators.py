"""Operators on small fixtures with known results."""

from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallywood import functions as fn
from tallywood.operators import groups, joins, pairs, ranking, rows

# Own rows: who bought what, as (shop, receipt, card, offer, price).
MEMBER_ORDERS = [
    (shop, f"r{n % 4}", card, f"{card}-{weeks}", 3 * weeks + n % 2)
    for n, (shop, card, weeks) in enumerate(
        (shop, card, weeks)
        for shop in ("harbour", "mill", "station")
        for card in ("blue", "green")
        for weeks in (1, 4, 12)
    )
]


def as_map(frame, key, value):
    return {r[key]: r[value] for r in frame.collect()}


@pytest.fixture(scope="module")
def members(spark):
    return spark.createDataFrame(
        MEMBER_ORDERS, "area string, goods string, member string, product string, price int"
    )


@pytest.fixture(scope="module")
def employees(spark):
    people = [("vera", "role-7", 10), ("vera", "desk", 250), ("vera", "night", 4100)]
    people += [("vera", "lead", 900), ("otto", "lead", 5200)]
    people += [("iris", "guide", 3300), ("juno", "lead", 7700)]
    return spark.createDataFrame(people, "name string, role string, salary int")


def added_up(keys):
    names = ("area", "goods", "member", "product")
    out = defaultdict(int)
    for row in MEMBER_ORDERS:
        out[tuple(row[names.index(k)] for k in keys)] += row[4]
    return dict(out)


def test_sum_by_three_keys(members):
    keys = ["area", "member", "product"]
    out = groups.sum_by(members, keys, {"total": "price"}).collect()
    assert {tuple(r[k] for k in keys): r["total"] for r in out} == added_up(keys)


def test_grouping_sets(members):
    sets = [["area"], ["goods"], ["member", "product"], ["area", "member", "product", "goods"]]
    found = groups.grouping_sets(members, sets, {"total": "price"}).collect()
    for one in sets:
        # The id counts the columns in the order they were first named.
        named = list(dict.fromkeys(c for s in sets for c in s))
        bits = sum(1 << (len(named) - 1 - named.index(c)) for c in named if c not in one)
        rows_ = {tuple(r[c] for c in one): r["total"] for r in found if r["grouping_id"] == bits}
        assert rows_ == added_up(one)
    assert len(found) == sum(len(added_up(one)) for one in sets)


def test_sums_take_values_as_they_are(spark):
    rows_ = [("small", 0.001), ("small", 0.004), ("small", 0.004), ("large", 1e18), ("large", 1e18),
             ("nan", float("nan")), ("nan", 1.0), ("none", None)]
    frame = spark.createDataFrame(rows_, "k string, v double")
    for out in (
        as_map(groups.sum_by(frame, ["k"], {"s": "v"}), "k", "s"),
        as_map(groups.class_totals(frame, "k", {"s": "v"}), "k", "total"),
        as_map(pairs.average_by_key(frame, "k", "v"), "k", "total"),
        as_map(pairs.partitioned_sum(frame, "k", "v", 2), "k", "total"),
        {r["k"]: r["s"] for r in groups.grouping_sets(frame, [["k"]], {"s": "v"}).collect()},
    ):
        assert out["small"] == pytest.approx(0.009, abs=1e-12)
        assert out["large"] == 2e18 and out["nan"] != out["nan"] and out["none"] is None


def test_grouping_id_tells_data_nulls_apart(spark):
    frame = spark.createDataFrame([(None, "x", 1), ("a", "x", 2)], "p string, q string, v int")
    out = groups.grouping_sets(frame, [["p"], ["q"]], {"s": "v"}).collect()
    assert sorted((str(r["p"]), str(r["q"]), r["grouping_id"], r["s"]) for r in out) == [
        ("None", "None", 1, 1.0),
        ("None", "x", 2, 3.0),
        ("a", "None", 1, 2.0),
    ]


def test_join_multiplicity(spark):
    left = [5, 5, 11, 8, 40, 40, 40]
    right = [40, 5, 5, 5, 8, 17, 17]
    a = spark.createDataFrame([(x,) for x in left], "key int")
    b = spark.createDataFrame([(x,) for x in right], "key int")
    expected = {x: left.count(x) * right.count(x) for x in set(left) & set(right)}
    assert as_map(joins.join_multiplicity(a, b, "key"), "key", "n") == expected


def test_word_count(spark):
    frame = spark.createDataFrame([("one two two",), (" three  three\nthree",)], "text string")
    assert as_map(pairs.count_words(frame, "text"), "word", "n") == {"one": 1, "two": 2, "three": 3}


def test_partitioned_sum_layout(spark):
    frame = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", 3.0)], "k string, v double")
    out = pairs.partitioned_sum(frame, "k", "v", 2)
    assert as_map(out, "k", "total") == {"a": 4.0, "b": 2.0}
    assert out.rdd.getNumPartitions() == 2


@pytest.mark.parametrize("parts", [1, 18])
def test_fold_start_counts_once_per_key(spark, parts):
    data = [("oak", 7), ("oak", -3), ("elm", 11), ("ash", 4), ("elm", 5), ("elm", 0)]
    frame = spark.createDataFrame(data, "k string, v int").repartition(parts)
    totals = as_map(pairs.fold_by_key(frame, "k", "v", 10), "k", "total")
    assert totals == {"oak": 14, "elm": 26, "ash": 14}


def test_average_by_key(spark):
    data = [("north", 12), ("south", 7), ("north", 15), ("south", 8), ("north", 6)]
    out = pairs.average_by_key(spark.createDataFrame(data, "k string, v int"), "k", "v").collect()
    assert {r["k"]: (r["total"], r["n"], r["average"]) for r in out} == {
        "north": (33.0, 3, 11.0),
        "south": (15.0, 2, 7.5),
    }


def test_zip_and_step_range(spark):
    def part(name, low, high):
        return spark.range(low, high).withColumnRenamed("id", name), [name]

    out = joins.zip_rows(a=part("a", 1, 4), b=part("b", 4, 7), c=part("c", 7, 10))
    assert sorted(tuple(r) for r in out.collect()) == [(0, 1, 4, 7), (1, 2, 5, 8), (2, 3, 6, 9)]
    assert [r["id"] for r in spark.range(1, 10, 2).collect()] == [1, 3, 5, 7, 9]
    with pytest.raises(Exception, match="differ in length"):
        joins.zip_rows(a=part("a", 1, 4), b=part("b", 4, 9)).collect()


def test_map_values(spark):
    frame = spark.createDataFrame([(10, "fir"), (20, ""), (30, "yew")], "k int, v string")
    assert as_map(pairs.map_values(frame, "v"), "k", "v") == {10: "fir_", 20: "_", 30: "yew_"}


def test_joined_set_and_extract(employees):
    kinds = pairs.distinct_values(employees, "name", "role")
    sets = pairs.joined_text(kinds, "name", "role", ",", size=10, name="cs")
    assert as_map(sets, "name", "cs")["vera"] == "desk,lead,night,role-7"
    extracted = sets.withColumn("ext", fn.extract_whole(F.col("cs"), r"role-(\d+)"))
    assert as_map(extracted, "name", "ext") == {"vera": "role-7", "otto": "", "iris": "", "juno": ""}


def test_words_of_shared_frequencies(spark):
    left = pairs.words_by_frequency(
        spark.createDataFrame([(w, 1) for w in "edcba"] + [("x", 2)], "word string, n int")
    )
    right = pairs.words_by_frequency(
        spark.createDataFrame([("q", 1), ("p", 1), ("y", 3)], "word string, n int")
    )
    found = {tuple(r) for r in pairs.shared_frequencies(left, right).collect()}
    expected = {(1, "left", i, w) for i, w in enumerate("abcde")}
    assert found == expected | {(1, "right", 0, "p"), (1, "right", 1, "q")}


def test_char_counts(spark):
    data = [("a", 1), ("b", 2)] + [("c", 3)] * 6
    out = pairs.sum_by_key(spark.createDataFrame(data, "k string, v int"), "k", F.col("v"))
    assert as_map(out, "k", "total") == {"a": 1, "b": 2, "c": 18}


@pytest.mark.parametrize("min_rows", [10**6, 10])
def test_ordered_values_of_equal_and_hot_rows(spark, min_rows):
    data = [("hot", i % 7) for i in range(100)] + [("cold", 5), (None, 3), ("gap", None)]
    frame = spark.createDataFrame(data, "k string, v int")
    found = pairs.ordered_values(frame, "k", "v", min_rows).collect()
    hot = sorted(tuple(r)[1:] for r in found if r["k"] == "hot")
    expected, at = [], 0
    for v in range(7):
        n = sum(1 for k, x in data if k == "hot" and x == v)
        expected.append((at, v, n))
        at += n
    assert hot == expected
    assert {tuple(r) for r in found if r["k"] != "hot"} == {
        ("cold", 0, 5, 1), (None, 0, 3, 1), ("gap", 0, None, 1),
    }


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_joined_text_has_every_value_in_order(spark, size):
    data = [("hot", i % 9) for i in range(100)] + [("cold", 5)]
    values = pairs.ordered_values(spark.createDataFrame(data, "k string, v int"), "k", "v")
    out = pairs.joined_text(values, "k", "v", "@", size=size).collect()
    hot = [r["joined"] for r in sorted(out, key=lambda r: r["part"]) if r["k"] == "hot"]
    assert "@".join(hot) == "@".join(str(v) for k, v in sorted(data) if k == "hot")
    assert len(hot) == -(-100 // size)
    assert [r["joined"] for r in out if r["k"] == "cold"] == ["5"]


def test_frequency_fixture(spark):
    data = [i * i % 13 for i in range(40)]
    out = groups.count_by(spark.createDataFrame([(x,) for x in data], "x int"), "x")
    assert as_map(out, "x", "n") == {x: data.count(x) for x in set(data)}


def test_weighted_entropy(spark):
    from math import log

    data = [(0, "a")] * 3 + [(0, "b")] + [(1, "a")] * 4
    got = groups.weighted_entropy(spark.createDataFrame(data, "g int, l string"), "g", "l")
    expected = 4 / 8 * -(0.75 * log(0.75) + 0.25 * log(0.25))
    assert got.head()["entropy"] == pytest.approx(expected)


def test_profile_and_pivot(employees):
    out = {r["column"]: r for r in groups.column_profile(employees, ["salary", "name"]).collect()}
    assert out["salary"]["count"] == 7 and out["salary"]["max"] == 7700.0
    assert out["name"]["mean"] is None and out["name"]["min_text"] == "iris"
    pivot = groups.pivot_counts(employees, "name", "role", ["lead", "guide"]).collect()
    assert {r["name"]: (r["lead"], r["guide"]) for r in pivot}["iris"] == (0, 1)


def test_threshold_keeps_ties(spark):
    frame = spark.createDataFrame([(x,) for x in [9, 8, 8, 8, 7, 1]], "x int")
    assert ranking.nth_largest(frame, "x", 2).head()["threshold"] == 8
    assert ranking.at_least_nth_largest(frame, "x", 2).count() == 4
    assert ranking.nth_largest(frame, "x", 100).head()["threshold"] == 1


def test_resolve_alias_falls_back_to_the_id(spark):
    plays = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "u int, item int")
    alias = spark.createDataFrame([(10, 99)], "bad int, good int")
    assert as_map(joins.resolve_alias(plays, "item", alias, "bad", "good"), "u", "item") == {
        1: 99, 2: 20, 3: 30,
    }


def test_parse_rules(spark):
    frame = spark.createDataFrame([("1",), ("x",), (None,), (" 7 ",)], "t string")
    assert sorted(r["v"] for r in rows.parse_or_drop(frame, "t", "int", "v").collect()) == [1, 7]
    values = frame.select(fn.parse_or(F.col("t"), "double", 0.0).alias("v")).collect()
    assert sorted(r["v"] for r in values) == [0.0, 0.0, 1.0, 7.0]


def test_null_counts(spark):
    frame = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert tuple(rows.null_counts(frame).head()) == (1, 2)


def test_splits_are_whole_and_repeatable(spark):
    frame = spark.range(2000).withColumnRenamed("id", "k")
    a, b = rows.key_split(frame, ["k"], [0.75, 0.25], seed=3)
    again, _ = rows.key_split(frame.repartition(7), ["k"], [0.75, 0.25], seed=3)
    left, right = {r["k"] for r in a.collect()}, {r["k"] for r in b.collect()}
    assert left | right == set(range(2000)) and not left & right
    assert left == {r["k"] for r in again.collect()}
    assert 1400 < len(left) < 1600
    c, d = rows.random_split(frame, [0.75, 0.25], seed=3)
    assert c.count() + d.count() == 2000


def test_stratified_samples_drop_unnamed_classes(spark):
    frame = spark.range(3000).select("id", (F.col("id") % 3).cast("string").alias("c"))
    out = rows.stratified_sample(frame, "c", {"0": 1.0, "1": 0.2}, seed=1)
    counts = {r["c"]: r["count"] for r in out.groupBy("c").count().collect()}
    assert counts["0"] == 1000 and 100 < counts["1"] < 300 and "2" not in counts
    stepped = rows.stratified_step_sample(frame, "c", {"0": 1, "1": 5}, F.col("id"))
    assert {r["c"]: r["count"] for r in stepped.groupBy("c").count().collect()} == {
        "0": 1000, "1": 200,
    }


def test_text_functions(spark):
    line = "Bigdata process framework is Hadoop,Hadoop, Hadoop Hadoop is an open source project"
    text = F.col("t")
    out = spark.createDataFrame([(line,)], "t string").select(
        fn.delete_all(text, "Hadoop").alias("deleted"),
        fn.replace_first(text, "Hadoop", "X$1").alias("first"),
        fn.replace_all(text, "Hadoop", "X").alias("every"),
        fn.word_count(text).alias("words"),
    ).head()
    assert "Hadoop" not in out["deleted"]
    assert out["first"] == line.replace("Hadoop", "X$1", 1)
    assert out["every"] == line.replace("Hadoop", "X")
    assert out["words"] == len(line.split())


def test_replace_first_spans_lines(spark):
    frame = spark.createDataFrame([("a\nb.c\nb.c",)], "t string")
    out = frame.select(fn.replace_first(F.col("t"), "b.c", "!").alias("t")).head()
    assert out["t"] == "a\n!\nb.c"


def test_suffix_after(spark):
    marker = "new_ProductDetail5.0"
    frame = spark.createDataFrame(
        [(f"x={marker}_b&y={marker}_a",), ("nothing",), (None,)], "t string"
    )
    out = frame.select(fn.suffix_after(F.col("t"), marker).alias("s")).collect()
    assert [r["s"] for r in out] == ["a", None, None]


def test_nested_rows(spark):
    frame = spark.createDataFrame([("a", 1), ("b", 10)], "k string, n int").select(
        *fn.row_of_all_kinds(
            [(F.col("k"), F.col("n"))],
            [F.col("n"), F.lit(5)],
            F.col("k"),
            {"num": F.col("n"), "str": F.col("k")},
        )
    )
    assert dict(frame.dtypes) == {
        "m": "map<string,int>", "a": "array<int>", "s": "string", "r": "struct<num:int,str:string>",
    }
    first = frame.head()
    assert first["m"] == {"a": 1} and first["a"] == [1, 5] and first["r"]["num"] == 1


def test_one_hot_index_and_distance(spark):
    frame = spark.createDataFrame([(0, 1, 0), (0, 0, 0), (1, 0, 0)], "a int, b int, c int")
    out = frame.select(fn.one_hot_index(["a", "b", "c"]).alias("i")).collect()
    assert [r["i"] for r in out] == [1.0, -1.0, 0.0]
    vectors = spark.createDataFrame([([1.0, 2.0], [4.0, 6.0])], "x array<float>, y array<float>")
    assert vectors.select(fn.squared_distance(F.col("x"), F.col("y"))).head()[0] == 25.0


def test_decode(spark):
    frame = spark.createDataFrame([(1,), (2,), (None,)], "c int")
    out = frame.select(fn.decode(F.col("c"), {1: "Male"}, "Female").alias("g")).collect()
    assert [r["g"] for r in out] == ["Male", "Female", None]


def test_union_keeps_duplicates_and_matches_names(spark):
    a = spark.createDataFrame([(1, 2, 3.0)], "x int, y int, loss double")
    b = spark.createDataFrame([(2, 1)], "y int, x int")
    out = rows.union_rows(a, b, ["loss"]).collect()
    assert [tuple(r) for r in out] == [(1, 2), (1, 2)]

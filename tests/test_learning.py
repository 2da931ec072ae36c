"""Features, searches, clustering and recommendation."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import HashingTF, StringIndexer, Tokenizer, VectorAssembler
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from tallywood.learning import cluster, features, inspect, models, recommend, tuning
from tallywood.plans import find_heavy


def test_frequency_index_equals_string_indexer(spark):
    frame = spark.createDataFrame([(x,) for x in "b a c c d d d".split()], "v string")
    got = features.frequency_index(frame, "v", "i")
    ml = StringIndexer(inputCol="v", outputCol="i").fit(frame).transform(frame)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ml.collect()))


def test_frequency_index_over_train_and_test(spark):
    train = spark.createDataFrame([("a",), ("b",)], "v string")
    test = spark.createDataFrame([("b",), ("c",), (None,)], "v string")
    out = features.frequency_index(test, "v", "i", fit_on=train.unionAll(test)).collect()
    assert {r["v"]: r["i"] for r in out} == {"b": 0.0, "c": 2.0, None: None}


def test_claim_feature_rule():
    columns = ["id", "cat1", "cat10", "cat109", "cat110", "cat116", "cont1", "label"]
    assert features.claim_features(columns) == ["coded_cat1", "coded_cat10", "cont1"]


def test_columns_keep_their_values_whatever_the_number(spark):
    frame = spark.range(20_000).select(
        F.col("id").cast("string").alias("many"),
        F.when(F.col("id") % 2 == 0, F.lit("A")).alias("some"), F.lit("one").alias("one"),
    )
    names = {c: f"{c}_code" for c in frame.columns}
    found = features.index_categories(frame, names).collect()
    assert len(found) == 20_000
    assert sorted(r["many_code"] for r in found) == [float(i) for i in range(20_000)]
    # A null in another column takes nothing from this one; null is the place after the last.
    assert {r["some_code"] for r in found if r["some"] == "A"} == {0.0}
    assert {r["some_code"] for r in found if r["some"] is None} == {1.0}
    assert {r["one_code"] for r in found} == {0.0}


def test_one_hot_has_a_column_for_every_value(spark):
    frame = spark.range(50).select((F.col("id") % 5).cast("double").alias("i"))
    found = features.one_hot(frame, "i", "flag", drop_last=False).distinct().collect()
    assert sorted(tuple(r)[1:] for r in found) == sorted(
        tuple(float(i == j) for j in range(5)) for i in range(5)
    )


def test_importances_keep_their_names(spark):
    frame = spark.range(300).select(
        (F.col("id") % 2).cast("double").alias("noise"),
        (F.col("id") % 10).cast("double").alias("signal"),
        (F.col("id") % 10 > 4).cast("double").alias("label"),
    )
    stages = [features.VectorAssembler(inputCols=["noise", "signal"], outputCol="features")]
    model = Pipeline(stages=[*stages, models.estimator("tree")]).fit(frame)
    names = features.feature_names(model.transform(frame), "features")
    top = features.importance_table(model, names, frame).head()
    assert (top["feature"], round(top["importance"], 6)) == ("signal", 1.0)


def test_learned_rules_and_parameters_can_be_read(spark):
    frame = spark.range(100).select(
        F.col("id").cast("double").alias("x"), (F.col("id") > 49).cast("double").alias("label")
    )
    stages = [features.VectorAssembler(inputCols=["x"], outputCol="features")]
    model = Pipeline(stages=[*stages, models.estimator("tree", maxDepth=2)]).fit(frame)
    table = {r["parameter"]: r["value"] for r in inspect.parameter_table(model, frame).collect()}
    assert table["maxDepth"] == "2" and table["seed"] == str(models.SEED)


def test_full_grids_have_the_stated_sizes():
    sizes = {}
    for name, grid in models.GRIDS.items():
        size = 1
        for values in grid.values():
            size *= len(values)
        sizes[name] = size
    assert sizes["churn_forest"] == 504 and sizes["churn_tree"] == 72
    assert sizes["cover_tree"] == 16 and sizes["cover_forest"] == 4 and sizes["text"] == 6
    assert models.folds_of("text") == 2 and models.folds_of("svm") == 10


def test_grid_names_must_be_known():
    with pytest.raises(ValueError):
        tuning.param_grid({"numTrees": [1]}, models.estimator("tree"))


def test_text_classifier_fixture(spark):
    texts = ["a b c d e spark", "b d", "spark f g h", "hadoop mapreduce", "b spark who", "g d a y"]
    texts += ["spark fly", "was mapreduce", "e spark program", "a e c l", "spark compile"]
    texts += ["hadoop software"]
    train = spark.createDataFrame(
        [(i, t, float("spark" in t)) for i, t in enumerate(texts)],
        "id long, text string, label double",
    )
    tokenizer = Tokenizer(inputCol="text", outputCol="words")
    hashing = HashingTF(inputCol="words", outputCol="features")
    model = models.estimator("logistic", maxIter=10)
    grid = tuning.param_grid(models.GRIDS["text"], hashing, model)
    best = tuning.cross_validate(
        train,
        Pipeline(stages=[tokenizer, hashing, model]),
        grid,
        BinaryClassificationEvaluator(),
        models.folds_of("text"),
        seed=1,
    )
    assert len(best.avgMetrics) == 6
    tests = ["spark i j k", "l m n", "mapreduce spark", "apache hadoop"]
    out = best.transform(
        spark.createDataFrame(list(enumerate(tests)), "id long, text string")
    ).collect()
    assert len(out) == 4
    assert all(0 <= r["probability"][1] <= 1 for r in out)
    board = tuning.leaderboard(best, BinaryClassificationEvaluator(), train).collect()
    metrics = [r["metric"] for r in board]
    assert metrics == sorted(metrics, reverse=True) and len(board) == 6


def test_kmeans_costs_fall_and_repeat(spark):
    frame = spark.range(200).select(
        (F.col("id") % 10).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("y")
    )
    stages, vector = cluster.feature_stages(["x", "y"], scaled=True)
    prepared = cluster.prepare(frame, stages)
    costs = cluster.cost_sweep(prepared, vector, [2, 8], **cluster.ITERATIONS)
    assert costs[0][1] > costs[1][1]
    again = cluster.cost_sweep(prepared, vector, [2, 8], **cluster.ITERATIONS)
    assert [c for _, c in again] == pytest.approx([c for _, c in costs])


def test_kmeans_anomalies_keep_ties_and_columns(spark):
    data = [(float(i % 5), "a", i) for i in range(50)]
    data += [(500.0 + i % 5, "b", i) for i in range(50, 100)]
    data += [(560.0, "b", 100), (560.0, "b", 101)]
    frame = spark.createDataFrame(data, "x double, c string, id int")
    model, vector = cluster.fit_pipeline(frame, ["x"], ["c"], 2, maxIter=5)
    out = cluster.kmeans_anomalies(frame, model, vector, rank=1)
    assert out.columns == ["x", "c", "id", "distance"]
    assert sorted(r["id"] for r in out.collect()) == [100, 101]


# --- recommendation ----------------------------------------------------------


@pytest.fixture(scope="module")
def taste(spark):
    """User 0 has most of the items; others have a few; 60 items in all."""
    pairs = [(0, i) for i in range(55)]
    pairs += [(u, (u * 7 + i * 11) % 60) for u in range(1, 40) for i in range(1 + u % 6)]
    pairs += [(99, i) for i in range(60)]
    return spark.createDataFrame(sorted(set(pairs)), "user long, item long").cache()


@pytest.mark.parametrize("min_rows", [10**6, 10])
def test_negatives(taste, min_rows):
    items = taste.select("item")
    out = recommend.sample_negatives(taste, items, "user", "item", min_rows=min_rows)
    found, owned = defaultdict(list), defaultdict(set)
    for r in out.collect():
        found[r["user"]].append(r["item"])
    for r in taste.collect():
        owned[r["user"]].add(r["item"])
    for user, mine in owned.items():
        drawn = found[user]
        assert len(drawn) == len(set(drawn)) == min(len(mine), 60 - len(mine))
        assert not mine & set(drawn)
    # The same walk, one user at a time.
    numbered, stride = list(range(60)), recommend.STRIDES[0]
    for user, mine in owned.items():
        walk = [
            numbered[(user * recommend.USER_STEP + i * stride) % 60]
            for i in range(min(2 * len(mine), 60))
        ]
        assert sorted(found[user]) == sorted([w for w in walk if w not in mine][: len(mine)])


@pytest.mark.parametrize("min_rows", [10**6, 10])
def test_user_auc_equals_comparing_all_pairs(spark, taste, min_rows):
    scores = spark.createDataFrame(
        [(i, i * 37 % 11) for i in range(60) if i % 5], "item long, prediction long"
    )

    def predict(rows):
        return recommend.predict_popularity(rows, scores, "item")

    negatives = recommend.sample_negatives(taste, taste.select("item"), "user", "item")
    heavy = find_heavy(taste, ["user"], min_rows)
    assert (heavy is None) == (min_rows > 1000)
    got = {
        r["user"]: (r["correct"], r["total"])
        for r in recommend.user_auc(taste, negatives, predict, "user", "item", heavy).collect()
    }
    score = {i: i * 37 % 11 for i in range(60) if i % 5}
    pos, neg = defaultdict(list), defaultdict(list)
    for r in taste.collect():
        pos[r["user"]].append(score.get(r["item"]))
    for r in negatives.collect():
        neg[r["user"]].append(score.get(r["item"]))
    expected = {}
    for user in pos:
        if neg[user]:
            right = sum(
                1 for a in pos[user] for b in neg[user] if None not in (a, b) and a > b
            )
            expected[user] = (right, len(pos[user]) * len(neg[user]))
    assert got == expected
    mean = recommend.mean_user_auc(taste, negatives, predict, "user", "item", heavy).head()
    assert mean["n_users"] == len(expected)
    assert mean["auc"] == pytest.approx(sum(c / t for c, t in expected.values()) / len(expected))


def test_aliased_counts_are_summed(spark):
    plays = spark.createDataFrame([(1, 10, 2), (1, 11, 3), (1, 10, 1)], "user int, item int, n int")
    alias = spark.createDataFrame([(11, 10)], "item int, alias int")
    out = recommend.interaction_counts(plays, "user", "item", "n", alias).collect()
    assert [tuple(r) for r in out] == [(1, 10, 6)]


def test_als_repeats_with_its_seed(taste):
    train = taste.withColumn("n", F.lit(1))
    small = {"rank": 3, "maxIter": 2}
    first = recommend.fit_als(train, "user", "item", "n", 5, **small)
    one = taste.select("user").where("user = 3").distinct()
    top = recommend.recommend(first, one, "user", "item", 4).collect()
    assert len(top) == 4
    assert [r["prediction"] for r in top] == sorted((r["prediction"] for r in top), reverse=True)


def test_hashed_counts_place_every_word_for_every_size(spark):
    texts = {1: ["a", "b", "a", ""], 2: [], 3: None, 4: ["\u00e9t\u00e9"] * 5}
    frame = spark.createDataFrame(list(texts.items()), "id int, words array<string>")
    found = {(r.id, r["size"], r.place): r.n for r in features.hashed_counts(frame, "id", "words", [3, 1000]).collect()}
    expected = Counter(
        (i, size, int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % size)
        for i, words in texts.items() for w in words or [] for size in (3, 1000)
    )
    assert found == dict(expected)
    with pytest.raises(ValueError, match="1 or more"):
        features.hashed_counts(frame, "id", "words", [0])


def test_hashed_counts_shuffle_hashes_by_key_once(spark, plan_text):
    frame = spark.createDataFrame([(1, ["a", "b", "a"]), (1, ["a"]), (2, None)], "id int, words array<string>")
    counts = features.hashed_counts(frame, "id", "words", [10, 100, 1000])
    plan = plan_text(counts)
    assert plan.count("Exchange\n") == 1 and "hashpartitioning(id" in plan
    assert sum(r.n for r in counts.where("size = 100").collect()) == 4


def test_hashed_counts_of_a_heavy_key_and_of_large_sizes(spark, monkeypatch):
    frame = spark.createDataFrame([(i % 3 or None, ["a", f"w{i}"]) for i in range(30)], "id int, words array<string>")
    sizes = [7, 65537, 65539]
    plain = sorted(map(str, features.hashed_counts(frame, "id", "words", sizes).collect()))
    real = features.find_heavy
    monkeypatch.setattr(features, "find_heavy", lambda df, keys: real(df, keys, min_rows=5))
    assert sorted(map(str, features.hashed_counts(frame, "id", "words", sizes).collect())) == plain


def test_few_rows_are_dealt_to_few_tasks(spark, monkeypatch):
    rows = spark.range(200).select((F.col("id") % 2).cast("double").alias("label"), F.rand(1).alias("x"))
    vectors = VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)
    model, tasks = models.estimator("logistic", maxIter=2), []
    fit = CrossValidator.fit
    monkeypatch.setattr(CrossValidator, "fit", lambda own, df: tasks.append(df.rdd.getNumPartitions()) or fit(own, df))
    tuning.cross_validate(
        vectors, model, tuning.param_grid({"regParam": [0.1]}, model), BinaryClassificationEvaluator(), 2, 1, n_rows=200
    )
    monkeypatch.setattr(tuning, "TASK_ROWS", 10)
    tuning.cross_validate(
        vectors, model, tuning.param_grid({"regParam": [0.1]}, model), BinaryClassificationEvaluator(), 2, 1, n_rows=200
    )
    assert tasks == [spark.sparkContext.defaultParallelism, 20]

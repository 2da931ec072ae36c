"""Readers, the coded text format and writers."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tallywood import sources

LINES = ["1, ann ,1,100,10", "2,bob, 2 ,200,20", "", "3 ,cyd,1,300,", "4,dan,0,50,5"]
PEOPLE = [
    ("1", "ann", "Male", 100, 10),
    ("2", "bob", "Female", 200, 20),
    ("3", "cyd", "Male", 300, None),
    ("4", "dan", "Female", 50, 5),
]


@pytest.fixture
def coded(tmp_path):
    path = tmp_path / "users"
    path.mkdir()
    (path / "part-0.txt").write_text("\n".join(LINES[:3]) + "\n")
    (path / "part-1.txt").write_text("\n".join(LINES[3:]))
    (path / "_SUCCESS").write_text("")
    return str(path)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_scan_decodes_and_trims(spark, coded):
    assert rows_of(sources.read_coded_text(spark, coded)) == PEOPLE


def test_user_schema(spark, coded):
    schema = "a int, b string, GENDER string, d bigint, e int"
    out = sources.read_coded_text(spark, coded, schema)
    assert out.dtypes[0] == ("a", "int")
    assert rows_of(out)[0] == (1, "ann", "Male", 100, 10)
    with pytest.raises(ValueError):
        sources.read_coded_text(spark, coded, "a double")


def test_selected_columns_come_by_name(spark, coded):
    out = sources.read_coded_text(spark, coded).select("name", "id")
    assert rows_of(out)[0] == ("ann", "1")


def test_odd_bytes_and_line_ends(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"1,\xff\xfe,1,5,6\r\n2,bob,0,7,8\n")
    found = rows_of(sources.read_coded_text(spark, str(tmp_path)).select("id", "salary", "expenses"))
    assert found == [("1", 5, 6), ("2", 7, 8)]


def test_pipe_text_round_trip(spark, tmp_path):
    frame = spark.createDataFrame([(1, "x"), (2, None)], "id int, name string")
    path = str(tmp_path / "out")
    sources.write_coded_text(frame, path)
    back = sources.read_coded_text(spark, path, frame.schema, "|")
    assert rows_of(back) == [(1, "x"), (2, None)]
    with pytest.raises(Exception, match="exist"):
        sources.write_coded_text(frame, path)
    sources.write_coded_text(frame, path, mode="append")
    assert sources.read_coded_text(spark, path, frame.schema, "|").count() == 4
    sources.write_coded_text(frame, path, mode="ignore")
    sources.write_coded_text(frame, path, mode="overwrite")
    assert sources.read_coded_text(spark, path, frame.schema, "|").count() == 2


def test_pipe_text_refuses_what_would_not_read_back(spark, tmp_path):
    frame = spark.createDataFrame([("a|b",)], "s string")
    with pytest.raises(Exception, match="delimiter"):
        sources.write_coded_text(frame, str(tmp_path / "bad"))
    with pytest.raises(ValueError):
        sources.write_coded_text(frame, str(tmp_path / "bad"), layout="xml")


def test_json_layout(spark, tmp_path):
    frame = spark.createDataFrame([("a|b", 1)], "s string, n int")
    sources.write_coded_text(frame, str(tmp_path / "j"), layout="json")
    assert rows_of(spark.read.schema(frame.schema).json(str(tmp_path / "j"))) == [("a|b", 1)]


def test_result_csv(spark, tmp_path):
    path = str(tmp_path / "csv")
    frame = spark.range(100).repartition(5)
    sources.write_result_csv(frame, path, single_file=True)
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1
    assert sources.read_csv_all_strings(spark, path).dtypes == [("id", "string")]
    with pytest.raises(Exception, match="exist"):
        sources.write_result_csv(frame, path, mode="error")


def test_positional_and_declared_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,x,2.5\n2,y,3.5\n")
    path = str(tmp_path / "a.csv")
    inferred = sources.read_csv_positional(spark, path, ["i", "s", "d"])
    assert inferred.dtypes == [("i", "int"), ("s", "string"), ("d", "double")]
    given = sources.read_csv_positional(spark, path, ["i", "s", "d"], "a bigint, b string, c double")
    assert given.dtypes[0] == ("i", "bigint")
    declared = sources.read_csv_declared(spark, path, "i int, s string, d double")
    assert rows_of(declared) == [(1, "x", 2.5), (2, "y", 3.5)]
    assert sources.read_csv_declared(spark, path, declared.schema, header=True).count() == 1


def test_text_fields(spark, tmp_path):
    (tmp_path / "t.txt").write_text("1 2 3\n4 x 6\n7\n")
    fields = {"a": "int", "b": "int", "c": "int"}
    out = sources.read_text_fields(spark, str(tmp_path / "t.txt"), fields)
    assert rows_of(out) == [(1, 2, 3), (4, None, 6), (7, None, None)]
    (tmp_path / "u.txt").write_text("1\tThe Band\nbad\tline\n")
    names = sources.read_text_fields(
        spark, str(tmp_path / "u.txt"), {"id": "int", "name": "string"}, "\t"
    )
    assert rows_of(names.where("id is not null")) == [(1, "The Band")]


def test_keyed_table(spark, tmp_path):
    people = spark.createDataFrame([("John", 30), ("Peter", 45)], "name string, age int")
    path = str(tmp_path / "people")
    sources.keyed_write(people, path, key="name", order_by=["age"])
    older = people.withColumn("age", F.col("age") + 1)
    sources.keyed_write(older.unionAll(people), path, key="name", order_by=["age"])
    assert rows_of(sources.keyed_read(spark, path)) == [("John", 31), ("Peter", 46)]
    loose = str(tmp_path / "loose")
    sources.keyed_write(people, loose)
    sources.keyed_write(people, loose)
    assert sources.keyed_read(spark, loose).count() == 4


def test_keyed_write_can_be_repeated(spark, tmp_path):
    people = spark.createDataFrame([("John", 30), (None, 7)], "name string, age int")
    path = str(tmp_path / "people")
    for _ in range(2):
        sources.keyed_write(people, path, key="name", order_by=["age"])
        assert sorted(rows_of(sources.keyed_read(spark, path)), key=str) == [("John", 30), (None, 7)]
    with pytest.raises(ValueError):
        sources.keyed_write(people, path, key="name")


def bucket_files(path, column):
    return {
        folder: sorted(os.listdir(os.path.join(path, folder)))
        for folder in os.listdir(path)
        if folder.startswith(f"{column}=")
    }


def test_keyed_write_leaves_other_buckets_alone(spark, tmp_path):
    path = str(tmp_path / "keyed")
    first = spark.range(500).select("id", F.lit("old").alias("v"), F.lit(1).alias("at"))
    sources.keyed_write(first, path, "id", ["at"], buckets=16)
    before = bucket_files(path, "_bucket")
    assert len(before) == 16
    second = spark.createDataFrame([(3, "new", 0), (3, "newer", 2), (900, "new", 0)], "id long, v string, at int")
    sources.keyed_write(second, path, "id", ["at"], buckets=16)
    after = bucket_files(path, "_bucket")
    assert 1 <= sum(before[b] != after[b] for b in before) <= 2
    found = {r["id"]: (r["v"], r["at"]) for r in sources.keyed_read(spark, path).collect()}
    assert found == {i: ("old", 1) for i in range(500)} | {3: ("newer", 2), 900: ("new", 0)}
    sources.keyed_write(second.limit(0), path, "id", ["at"], buckets=16)
    assert bucket_files(path, "_bucket") == after


def test_insert_overwrites_only_buckets_with_rows(spark, tmp_path):
    path, name = str(tmp_path / "parts"), "bucketed_rows"
    spark.sql(f"drop table if exists {name}")
    rows = spark.range(200).select("id", F.lit("old").alias("v"))
    sources.overwrite_buckets(rows, path, name, "id", buckets=8)
    before = bucket_files(path, "bucket")
    chosen = spark.table(name).where("bucket in (2, 5)").select("id").withColumn("v", F.lit("new"))
    chosen = spark.createDataFrame(chosen.collect(), "id long, v string")
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    sources.overwrite_buckets(chosen, path, name, "id", buckets=8)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    after = bucket_files(path, "bucket")
    assert {b for b in before if before[b] != after[b]} == {"bucket=2", "bucket=5"}
    found = spark.table(name)
    assert found.count() == 200
    assert found.where("(v = 'new') != (bucket in (2, 5))").count() == 0
    spark.sql(f"drop table {name}")


def test_overwrite_table(spark, tmp_path):
    path = str(tmp_path / "table")
    name = sources.overwrite_table(spark.range(3), path)
    assert sources.overwrite_table(spark.range(2), path, name) == name
    assert spark.table(name).count() == 2
    spark.sql(f"drop table {name}")


def test_publish_is_binary(spark):
    numbered = spark.range(1, 101)
    messages = sources.publish(
        numbered, F.col("id"), F.concat("id", F.lit(": a message")), "topic"
    )
    assert dict(messages.dtypes) == {"topic": "string", "key": "binary", "value": "binary"}
    assert messages.where("cast(key as string) = '7'").head()["value"] == b"7: a message"
    assert messages.count() == 100


def test_large_ids_are_kept(spark, tmp_path):
    from tallywood.sources import layouts

    (tmp_path / "plays.txt").write_text("3000000000 5 1\nbroken line\n")
    assert rows_of(layouts.read_plays(spark, str(tmp_path / "plays.txt"))) == [(3000000000, 5, 1)]

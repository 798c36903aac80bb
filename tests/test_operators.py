from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart import operators as op
from clickmart.operators.materialize import checkpoint_root


def table(spark, *data):
    return spark.createDataFrame(list(data), "id long, a string, b string")


def test_upsert_replaces_and_inserts(spark):
    target = table(spark, (1, "a", "x"), (2, "b", "y"))
    updates = table(spark, (2, "B", None), (3, "c", "z"))
    merged = op.upsert(target, updates, ["id"])
    assert rows(merged) == [(1, "a", "x"), (2, "B", None), (3, "c", "z")]
    assert rows(op.upsert(merged, updates, ["id"])) == rows(merged)


def test_upsert_of_some_columns_keeps_the_rest(spark):
    target = table(spark, (1, "a", "x"), (2, "b", "y"), (4, None, "q"))
    updates = table(spark, (2, None, "new"), (3, "c", "z"), (4, "d", "e"))
    merged = op.upsert(target, updates, ["id"], ["a"])
    assert rows(merged) == [(1, "a", "x"), (2, None, "y"), (3, "c", "z"), (4, "d", "q")]
    assert rows(op.upsert(merged, updates, ["id"], ["a"])) == rows(merged)


def test_upsert_pairs_null_keys_and_refuses_duplicates(spark):
    target = table(spark, (None, "a", "x"), (1, "b", "y"))
    updates = table(spark, (None, "A", "X"))
    for columns in (None, ["a", "b"]):
        assert rows(op.upsert(target, updates, ["id"], columns)) == [(None, "A", "X"), (1, "b", "y")]
        for twice in (updates.union(updates), table(spark, (1, "p", "q"), (1, "r", "s"))):
            with pytest.raises(Exception, match="held twice"):
                op.upsert(target, twice, ["id"], columns).collect()


def test_insert_ignore_keeps_the_first_along_an_order(spark):
    target = table(spark, (None, "a", "x"))
    new = table(spark, (None, "z", "z"), (2, "b", "2"), (2, "c", "1"))
    assert rows(op.insert_ignore(target, new, ["id"])) == [(None, "a", "x"), (2, "b", "2")]
    assert rows(op.insert_ignore(target, new, ["id"], ["b"])) == [(None, "a", "x"), (2, "c", "1")]


def test_upsert_with_missing_columns(spark):
    target = table(spark, (1, "a", "x"))
    updates = spark.createDataFrame([(1, "A"), (2, "B")], "id int, a string")
    assert rows(op.upsert(target, updates, ["id"], ["a"])) == [(1, "A", "x"), (2, "B", None)]


def test_insert_ignore(spark):
    target = table(spark, (1, "a", "x"))
    new = table(spark, (1, "z", "z"), (2, "b", "y"), (2, "b", "y"))
    assert rows(op.insert_ignore(target, new, ["id"])) == [(1, "a", "x"), (2, "b", "y")]


def test_lead_by_key_equals_brute_force(spark):
    draw = random.Random(7)
    data = []
    for i in range(3000):
        # One key holds a third of the rows, and many of those share a moment.
        key = "hot" if draw.random() < 0.34 else f"k{draw.randrange(40)}"
        data.append((key, draw.randrange(5), i, f"p{draw.randrange(9)}"))
    df = spark.createDataFrame(data, "key string, t long, id long, p string").repartition(5)
    expected = []
    for key in {d[0] for d in data}:
        mine = sorted(d for d in data if d[0] == key)
        following = [d[3] for d in mine[1:]] + [None]
        expected += [(*d, n) for d, n in zip(mine, following, strict=True)]
    expected = sorted(expected, key=lambda r: r[2])
    for ranges in (None, 1, 7, 200):
        result = op.lead_by_key(df, "key", ["t", "id"], "p", "n", ranges)
        assert sorted((tuple(r) for r in result.collect()), key=lambda r: r[2]) == expected


def test_top_n_and_best_value(spark):
    df = spark.createDataFrame(
        [("g", "b", 2), ("g", "a", 2), ("g", "c", 1), ("h", None, 9), ("h", "z", 1)],
        "g string, v string, n long",
    )
    best = df.groupBy("g").agg(op.best_value(F.col("v"), F.col("n"), F.lit(True)).alias("best"))
    assert rows(best) == [("g", "a"), ("h", "z")]
    top = op.top_n(df, ["g"], [F.desc("n"), F.asc("v")], 2, "r")
    assert rows(top.where("g = 'g'").select("v", "r")) == [("a", 1), ("b", 2)]
    lists = top.groupBy("g").agg(op.collect_ranked("r", "v").alias("vs"))
    assert {r.g: r.vs for r in lists.collect()}["g"] == ["a", "b"]


def test_materialize_uses_the_named_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_root(spark) == root
    kept = op.materialize(spark.range(5))
    assert kept.count() == 5 and all(root in f for f in kept.inputFiles())


def test_quality_checks(spark):
    df = table(spark, (1, "a", None), (1, "q", "x"), (2, None, None))
    assert rows(op.check_unique(df, ["id"])) == [(1, 2)]
    assert rows(op.check_not_null(df, ["a", "b"])) == [("a", 1), ("b", 2)]
    assert rows(op.check_allowed(df, "a", ["a"]).select("a")) == [("q",)]
    parent = table(spark, (1, "m", "n"))
    assert rows(op.check_reference(df, "id", parent, "id").select("id")) == [(2,)]
    assert op.check_non_empty({"full": df, "none": df.limit(0)}) == ["none"]
    assert rows(op.row_counts({"full": df, "none": df.limit(0)})) == [("full", 3), ("none", 0)]
    assert [r.id for r in op.sample_rows(df, "id", 2).collect()] == [1, 1]
    wanted = T.StructType.fromDDL("id long, a int, c string")
    assert rows(op.check_schema(df, wanted)) == [
        ("a", "int", "string"),
        ("b", None, "string"),
        ("c", "string", None),
    ]
    assert op.check_schema(df, df.schema).isEmpty()


def test_partition_files(spark, tmp_path):
    path = str(tmp_path / "lake")
    events = spark.range(6).withColumn("event_type", F.when(F.col("id") < 2, "a").otherwise("b"))
    events.coalesce(1).write.partitionBy("event_type").parquet(path)
    assert rows(op.partition_files(spark.read.parquet(path))) == [("a", 1, 2), ("b", 1, 4)]


def test_number_rows_equals_brute_force(spark):
    draw = random.Random(4)
    data = [(i, draw.choice([0.5, 0.1, None])) for i in range(500)]
    df = spark.createDataFrame(data, "id long, score double").repartition(7)
    found = op.number_rows(df, [F.desc_nulls_last("score"), F.asc("id")], "place").collect()
    ordered = sorted(data, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert {r.id: r.place for r in found} == {r[0]: i for i, r in enumerate(ordered, start=1)}
    assert op.number_rows(df.limit(0), [F.asc("id")], "place").isEmpty()

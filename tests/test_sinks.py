from __future__ import annotations

import pytest

from concurrent.futures import ThreadPoolExecutor

import json
import uuid
from pathlib import Path

from conftest import rows
from pyspark.sql import functions as F

from clickmart import sinks


def frame(spark, *values):
    return spark.createDataFrame([(v, v * 10) for v in values], "id long, amount long")


def test_versions_allow_reading_while_writing(spark, tmp_path):
    root = str(tmp_path / "table")
    assert sinks.latest_version(spark, root) == 0
    assert sinks.write_version(frame(spark, 1, 2), root) == 1
    grown = sinks.read_version(spark, root).unionByName(frame(spark, 3))
    assert sinks.write_version(grown, root) == 2
    assert sinks.read_version(spark, root).count() == 3
    assert sinks.read_version(spark, root, 1).count() == 2
    (tmp_path / "table" / "version=3").mkdir()
    assert sinks.latest_version(spark, root) == 2


def test_catalog_tables(spark):
    sinks.overwrite_table(frame(spark, 1), "t_sink")
    sinks.append_table(frame(spark, 1), "t_sink")
    assert spark.table("t_sink").count() == 2
    sinks.insert_overwrite(frame(spark, 5), "t_sink")
    assert rows(spark.table("t_sink")) == [(5, 50)]
    sinks.replace_view(frame(spark, 6), "v_sink")
    sinks.replace_view(frame(spark, 7), "v_sink")
    assert rows(spark.table("v_sink")) == [(7, 70)]


def test_bucketed_tables_join_without_exchange(spark):
    for name in ("b_left", "b_right"):
        sinks.write_bucketed(frame(spark, *range(100)), name, "id", 4)
    left, right = spark.table("b_left").hint("merge"), spark.table("b_right")
    plan = left.join(right, "id")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_csv(spark, tmp_path):
    sinks.write_csv(frame(spark, 1), str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).columns == ["id", "amount"]


def test_serving_options():
    options = sinks.serving_options("jdbc:x", "t")
    assert options == {"url": "jdbc:x", "dbtable": "t", "truncate": "true", "batchsize": "1000"}


def test_publish_options():
    options = sinks.publish_options("b:9092", "user_events")
    assert options["topic"] == "user_events" and options["kafka.acks"] == "all"


def test_segment_items(spark):
    segments = spark.createDataFrame(
        [(None, "", None, None, None, "", None), ("u1", "VIP", 1200.5, 3, "b", "c", "2024-01-02")],
        "user_id string, segment string, total_spend double, total_purchases long, "
        "favorite_brand string, most_viewed_category string, last_seen_date string",
    ).withColumn("last_seen_date", F.col("last_seen_date").cast("timestamp"))
    items = {r.user_id: r for r in sinks.segment_items(segments, "2024-02-01").collect()}
    empty = items["unknown"]
    assert (empty.customer_segment, empty.total_spend, empty.total_purchases) == ("Unknown", 0.0, 0)
    assert empty.favorite_brand == empty.last_seen_date == ""
    assert items["u1"].last_seen_date == "2024-01-02 00:00:00"
    assert items["u1"].export_timestamp == "2024-02-01T00:00:00"


def test_recommendation_items_take_arrays_and_json(spark):
    schema = "user_id string, recommended_products {}, recommendation_reason string, " \
        "recommendation_date timestamp"
    arrays = spark.createDataFrame(
        [("u", ["12", "prod_1", "3.7"], "r", None), ("v", None, None, None)],
        schema.format("array<string>"),
    )
    texts = spark.createDataFrame(
        [("u", '["12", "prod_1", "3.7"]', "r", None), ("v", "broken", None, None)],
        schema.format("string"),
    )
    for df in (arrays, texts):
        items = {r.user_id: r for r in sinks.recommendation_items(df, "2024-02-01").collect()}
        assert items["u"].recommended_products == [12, 0, 3]
        assert items["v"].recommended_products == []


def json_writer(folder: str):
    class Writer:
        """Writes the items of one partition to a file of its own."""

        def __enter__(self):
            self.file = (Path(folder) / f"{uuid.uuid4().hex}.json").open("w")
            return self

        def put_item(self, item: dict) -> None:
            self.file.write(json.dumps(item) + "\n")

        def __exit__(self, *error) -> None:
            self.file.close()

    return Writer


def test_put_items_runs_per_partition(spark, tmp_path):
    folder = str(tmp_path)
    sinks.put_items(spark.range(10).repartition(3), json_writer(folder))
    written = [json.loads(line) for f in tmp_path.glob("*.json") for line in f.open()]
    assert sorted(i["id"] for i in written) == list(range(10))


def test_items_json(spark, tmp_path):
    path = str(tmp_path / "items")
    sinks.write_items_json(frame(spark, 1, 2), path)
    assert spark.read.json(path).count() == 2


def test_concurrent_writers_get_versions_of_their_own(spark, tmp_path):
    root = str(tmp_path / "table")
    with ThreadPoolExecutor(4) as pool:
        made = list(pool.map(lambda n: sinks.write_version(spark.range(n), root), range(1, 7)))
    assert sorted(made) == [1, 2, 3, 4, 5, 6]
    assert sorted(sinks.read_version(spark, root, v).count() for v in made) == [1, 2, 3, 4, 5, 6]


def test_stored_view_follows_its_table(spark):
    frame(spark, 1).write.mode("overwrite").saveAsTable("stored_view_base")
    sinks.replace_stored_view(spark, "stored_view", "SELECT id FROM stored_view_base")
    sinks.replace_stored_view(spark, "stored_view", "SELECT amount FROM stored_view_base")
    assert rows(spark.table("stored_view")) == [(10,)]
    assert [t.isTemporary for t in spark.catalog.listTables() if t.name == "stored_view"] == [False]


BUCKETED = "k string, part int, a long, b string"


def files_below(root):
    return {str(p.relative_to(root)) for p in root.rglob("*.parquet") if "places" not in str(p)}


def test_an_upsert_writes_only_the_buckets_it_touches(spark, tmp_path):
    from clickmart.operators import upsert
    from clickmart.sinks import read_buckets, upsert_buckets, write_buckets

    root = str(tmp_path / "table")
    before = spark.range(500).selectExpr("concat('k', id) AS k", "int(id % 3) AS part", "id AS a", "'old' AS b")
    before = before.union(spark.createDataFrame([(None, 0, 7, "old"), ("lone", None, 8, None)], BUCKETED))
    assert write_buckets(before, root, ["k", "part"], 16) == 1
    assert rows(read_buckets(spark, root, BUCKETED)) == rows(before)
    first = files_below(tmp_path / "table")
    reader = read_buckets(spark, root, BUCKETED)
    updates = spark.createDataFrame([("k1", 1, 100, None), (None, 0, 200, "new"), ("fresh", 5, 1, "new")], BUCKETED)
    assert upsert_buckets(updates, root, BUCKETED) == 2
    once = upsert(before, updates, ["k", "part"])
    assert rows(read_buckets(spark, root, BUCKETED)) == rows(once)
    second = files_below(tmp_path / "table")
    assert first <= second and 1 <= len(second - first) <= 3
    assert rows(reader) == rows(before), "who reads keeps its files"
    assert upsert_buckets(updates.limit(1), root, BUCKETED, ["b"]) == 3
    assert rows(read_buckets(spark, root, BUCKETED)) == rows(upsert(once, updates.limit(1), ["k", "part"], ["b"]))
    with pytest.raises(Exception, match="held twice"):
        upsert_buckets(updates.union(updates), root, BUCKETED)
    assert upsert_buckets(updates.where("false"), root, BUCKETED) == 4


def test_two_upserts_at_once_do_not_lose_rows(spark, tmp_path):
    from clickmart.sinks import buckets, read_buckets, upsert_buckets, write_buckets

    root = str(tmp_path / "table")
    write_buckets(spark.createDataFrame([("x", 1, 1, "x")], BUCKETED), root, ["k"], 4)
    places = buckets._places(spark, root)
    upsert_buckets(spark.createDataFrame([("y", 1, 1, "y")], BUCKETED), root, BUCKETED)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(buckets, "_places", lambda *_: places)
        with pytest.raises(ValueError, match="meanwhile"):
            upsert_buckets(spark.createDataFrame([("z", 1, 1, "z")], BUCKETED), root, BUCKETED)
    assert {r.k for r in read_buckets(spark, root, BUCKETED).collect()} == {"x", "y"}

from __future__ import annotations

import time

from conftest import rows
from pyspark.sql import functions as F

from clickmart.plans import profiles, similarity
from clickmart.schema import LAKE_SCHEMA, conform
from clickmart.sinks import publish_events, read_version
from clickmart.sources import read_event_stream, read_lake, star_schema
from clickmart.streaming import (
    compact_features,
    read_features,
    start_feature_refresh,
    start_ingest,
    start_rejects,
)


def test_ingest_restarts_without_duplicates(spark, data, tmp_path):
    wire, lake, checkpoint = (str(tmp_path / n) for n in ("wire", "lake", "checkpoint"))
    events = star_schema.clickstream(spark, data)
    early = F.col("event_id") % 2 == 0
    publish_events(events.where(early), path=wire)
    spark.createDataFrame([("broken",), ('{"event_type":"view"}',)], "value string").write.mode(
        "append"
    ).text(wire)

    def run():
        start_ingest(read_event_stream(spark, path=wire), lake, checkpoint, None).awaitTermination()

    run()
    first = read_lake(spark, lake).count()
    assert first == events.where(early).count()
    run()
    assert read_lake(spark, lake).count() == first
    publish_events(events.where(~early), path=wire)
    run()
    assert rows(read_lake(spark, lake)) == rows(conform(events, LAKE_SCHEMA))


def test_ingest_with_a_timed_trigger(spark, tmp_path):
    wire, lake, checkpoint = (str(tmp_path / n) for n in ("wire", "lake", "checkpoint"))
    spark.createDataFrame([('{"event_type":"view","user_id":"u"}',)], "value string").write.text(
        wire
    )
    stream = read_event_stream(spark, path=wire, max_files=1)
    query = start_ingest(stream, lake, checkpoint, "1 second")
    try:
        query.processAllAvailable()
        time.sleep(0.1)
        assert read_lake(spark, lake).count() == 1
    finally:
        query.stop()


def test_features_follow_the_interactions(spark, data, tmp_path):
    source, root, checkpoint, table = (
        str(tmp_path / n) for n in ("source", "features", "checkpoint", "table")
    )
    interactions = similarity.interactions_from_events(star_schema.clickstream(spark, data))
    early = F.col("interaction_time") < "2024-01-15"

    def run():
        stream = spark.readStream.schema(interactions.schema).parquet(source)
        start_feature_refresh(stream, root, checkpoint, None).awaitTermination()

    assert read_features(spark, root).isEmpty()
    interactions.where(early).write.parquet(source)
    run()
    wanted = profiles.user_behavior_features(interactions.where(early))
    assert rows(read_features(spark, root)) == rows(wanted)
    interactions.where(~early).write.mode("append").parquet(source)
    run()
    run()
    wanted = profiles.user_behavior_features(interactions)
    assert rows(read_features(spark, root)) == rows(wanted)
    assert compact_features(spark, root, table) == 1
    assert rows(read_version(spark, table)) == rows(wanted)
    assert rows(read_features(spark, root)) == rows(wanted)


def test_features_survive_a_new_checkpoint(spark, tmp_path):
    source, root, table = (str(tmp_path / n) for n in ("source", "features", "table"))
    schema = "user_id string, product_id string, interaction_type string, strength int, interaction_time timestamp"

    def views(user, n):
        one = spark.createDataFrame([(user, "p", "view", 1)], "user_id string, product_id string, interaction_type string, strength int")
        return one.withColumn("interaction_time", F.lit("2024-01-01").cast("timestamp")).crossJoin(spark.range(n).select()).select(
            "user_id", "product_id", "interaction_type", "strength", "interaction_time"
        )

    def run(checkpoint):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        start_feature_refresh(stream, root, str(tmp_path / checkpoint), None).awaitTermination()

    def totals():
        return {r.user_id: r.total_views for r in read_features(spark, root).collect()}

    views("u", 3).coalesce(1).write.parquet(source)
    run("first")
    assert totals() == {"u": 3}
    views("u", 5).coalesce(1).write.mode("append").parquet(source)
    run("second")
    assert totals() == {"u": 8}
    compact_features(spark, root, table)
    views("v", 2).coalesce(1).write.mode("append").parquet(source)
    run("second")
    assert totals() == {"u": 8, "v": 2}
    spark.createDataFrame([("u", 99)], "user_id string, total_views long").write.parquet(f"{root}/batch-9-9")
    (tmp_path / "features" / "batch-9-9" / "_SUCCESS").unlink()
    assert totals() == {"u": 8, "v": 2}


SCHEMA = "user_id string, product_id string, interaction_type string, interaction_time timestamp, price double"


def bought(spark, path, *rows):
    one = spark.createDataFrame([(u, "p", kind, price) for u, kind, price in rows], "user_id string, product_id string, interaction_type string, price double")
    one = one.withColumn("interaction_time", F.lit("2024-01-01").cast("timestamp"))
    one.select("user_id", "product_id", "interaction_type", "interaction_time", "price").coalesce(1).write.mode("append").parquet(path)


def test_a_new_checkpoint_goes_on_counting(spark, tmp_path):
    root, table = str(tmp_path / "features"), str(tmp_path / "table")

    def run(source, checkpoint):
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        start_feature_refresh(stream, root, str(tmp_path / checkpoint), None).awaitTermination()

    def totals():
        return {r.user_id: (r.total_views, r.total_purchases, r.total_spend) for r in read_features(spark, root).collect()}

    first, second = str(tmp_path / "a"), str(tmp_path / "b")
    bought(spark, first, *[("u", "view", 1.0)] * 8, ("w", "purchase", 0.1))
    run(first, "one")
    bought(spark, second, *[("u", "view", 1.0)] * 2, ("w", "purchase", 0.2), (None, "view", 1.0))
    run(second, "two")
    wanted = {"u": (10, 0, 0.0), "w": (0, 2, 0.3), None: (1, 0, 0.0)}
    assert totals() == wanted
    compact_features(spark, root, table)
    assert totals() == wanted
    # A batch that is run again, because its end was not recorded, changes nothing.
    for checkpoint in ("one", "two"):
        for name in (tmp_path / checkpoint / "commits").glob("*0*"):
            name.unlink()
        for name in (tmp_path / checkpoint / "commits").glob(".0*"):
            name.unlink()
    run(first, "one")
    run(second, "two")
    assert totals() == wanted
    # Both runs go on, and a third one that reads everything again counts only what is new.
    bought(spark, first, ("u", "purchase", 5.0))
    bought(spark, second, ("u", "view", 1.0))
    run(first, "one")
    run(second, "two")
    wanted["u"] = (11, 1, 5.0)
    assert totals() == wanted
    bought(spark, first, ("v", "view", 1.0))
    run(first, "three")
    run(second, "four")
    assert totals() == wanted | {"v": (1, 0, 0.0)}
    assert compact_features(spark, root, table) == 2
    assert totals() == wanted | {"v": (1, 0, 0.0)}


def test_features_from_a_source_without_files(spark, tmp_path):
    stream = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 5).option("numPartitions", 1).load()
    views = stream.select(
        F.lit("u").alias("user_id"), F.lit("view").alias("interaction_type"), F.col("timestamp").alias("interaction_time")
    )
    root = str(tmp_path / "features")
    query = start_feature_refresh(views, root, str(tmp_path / "checkpoint"), "1 second")
    try:
        while query.lastProgress is None:
            time.sleep(0.2)
    finally:
        query.stop()
    seen = read_features(spark, root).collect()
    assert len(seen) == 1 and seen[0].total_views % 5 == 0 and seen[0].total_views > 0


def test_messages_land_in_the_lake_or_among_the_rejected(spark, tmp_path):
    wire, lake, kept = (str(tmp_path / n) for n in ("wire", "lake", "rejected"))

    def send(*values):
        spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.mode("append").text(wire)

    def run():
        stream = read_event_stream(spark, path=wire)
        query = start_ingest(stream, lake, str(tmp_path / "c1"), None)
        query.awaitTermination()
        start_rejects(stream, kept, str(tmp_path / "c2"), None).awaitTermination()
        return [p["observedMetrics"]["ingest"] for p in query.recentProgress if p["numInputRows"]]

    send('{"user_id":"u1","event_type":"view"}', "broken", '{"event_type":"view"}')
    seen = run()
    assert [(m["read"], m["accepted"], m["rejected"]) for m in seen] == [(3, 1, 2)]
    run()
    send("broken too", '{"user_id":"u2","event_type":"cart"}')
    run()
    run()
    assert {r.user_id for r in read_lake(spark, lake).collect()} == {"u1", "u2"}
    rejected = spark.read.schema("raw string, reason string").json(kept)
    assert rows(rejected) == [("broken", "not valid JSON"), ("broken too", "not valid JSON"), ('{"event_type":"view"}', "no user")]

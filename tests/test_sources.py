from __future__ import annotations

import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from clickmart import sources
from clickmart.schema import (
    CANONICAL_SCHEMA,
    EVENT_TYPES,
    LAKE_SCHEMA,
    WIRE_FIELDS,
    conform,
    lower_columns,
    upper_columns,
)
from clickmart.sources import star_schema
from clickmart.sources.tables import jdbc_read_options

HEADER = ",".join(WIRE_FIELDS)


def test_csv_blanks_and_quotes(spark, tmp_path):
    file = tmp_path / "events.csv"
    file.write_text(
        HEADER + '\n2019-10-01 00:00:00 UTC,view,1,2,,"a ""b"", c",9.5,u1,s1\n'
        "2019-10-01 00:00:01 UTC,cart,2,2,x,,,u2,\n"
    )
    df = sources.read_events_csv(spark, str(file))
    first, second = sorted(df.collect(), key=lambda r: r.product_id)
    assert first.brand == 'a "b", c' and first.category_code is None
    assert second.price is None and second.user_session is None
    assert {t for _, t in df.dtypes} == {"string"}
    kept = sources.read_events_csv(spark, str(file), keep_empty=True)
    assert kept.where("brand = ''").count() == 1


def test_csv_columns_go_by_name(spark, tmp_path):
    file = tmp_path / "events.csv"
    file.write_text("user_id,event_type\nu1,view\n")
    row = sources.read_events_csv(spark, str(file)).first()
    assert (row.user_id, row.event_type, row.price) == ("u1", "view", None)


def test_csv_files_with_other_column_orders(spark, tmp_path):
    (tmp_path / "a.csv").write_text("event_type,user_id,price\nview,u1,1.5\n")
    (tmp_path / "b.csv").write_text("price,event_time,user_id,event_type\n2.5,2024-01-02 00:00:00,u2,cart\n")
    (tmp_path / "c.csv").write_text("")
    found = sources.read_events_csv(spark, str(tmp_path))
    assert rows(found.select("user_id", "event_type", "price", "event_time")) == [
        ("u1", "view", "1.5", None),
        ("u2", "cart", "2.5", "2024-01-02 00:00:00"),
    ]


def test_decode_bad_messages(spark):
    values = [
        '{"event_time":"2019-10-01 00:00:00 UTC","event_type":"view","price":"1.50",'
        '"user_id":"u1","brand":""}',
        '{"event_type":"view","price":"abc","event_time":"never","user_id":"u2"}',
        '{"event_type":"view","user_id":""}',
        "not json",
        "{}",
    ]
    wire = spark.createDataFrame([(v,) for v in values], "value string")
    decoded = sources.decode_events(wire)
    assert decoded.count() == len(values)
    valid = {r.user_id: r for r in sources.valid_events(decoded).collect()}
    assert set(valid) == {"u1", "u2"}
    assert valid["u1"].price == 1.5 and valid["u1"].brand is None
    assert valid["u1"].event_time == datetime.datetime(2019, 10, 1)
    assert valid["u2"].price is None and valid["u2"].event_time is None
    binary = wire.select(F.col("value").cast("binary").alias("value"))
    assert rows(sources.decode_events(binary)) == rows(decoded)
    kept = sources.decode_events(wire, keep_empty=True)
    assert sources.valid_events(kept).where("user_id = ''").count() == 1


def _lake(spark, path):
    events = spark.createDataFrame(
        [("view", "p1", "u1"), ("cart", "p2", "u1"), ("view", "p3", "u2")],
        "event_type string, product_id string, user_id string",
    )
    conform(events, LAKE_SCHEMA).write.partitionBy("event_type").parquet(path)


def test_lake(spark, tmp_path):
    path = str(tmp_path / "lake")
    assert sources.read_lake(spark, path).isEmpty()
    _lake(spark, path)
    assert sources.read_lake(spark, path).count() == 3
    views = sources.read_lake(spark, path, ["view"])
    assert rows(views.select("product_id")) == [("p1",), ("p3",)]
    assert "PartitionFilters: [" in views._jdf.queryExecution().toString()
    other = str(tmp_path / "other")
    _lake(spark, other)
    assert sources.read_lake(spark, [path, other]).count() == 6
    both = sources.read_lake_glob(spark, path)
    assert rows(both.select("event_type", "product_id")) == [
        ("cart", "p2"),
        ("view", "p1"),
        ("view", "p3"),
    ]


def test_kafka_options():
    options = sources.kafka_options("b:9092", "user_events", "earliest", security_protocol="SSL")
    assert options["subscribe"] == "user_events"
    assert options["startingOffsets"] == "earliest"
    assert options["kafka.security.protocol"] == "SSL"
    assert sources.kafka_options("b", "t")["startingOffsets"] == "latest"


def test_jdbc_options_split_the_read():
    options = jdbc_read_options("jdbc:x", "t", "id", 0, 100, 8)
    assert options["numPartitions"] == "8" and options["partitionColumn"] == "id"
    assert "partitionColumn" not in jdbc_read_options("jdbc:x", "t")


def test_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS staging")
    for name in EVENT_TYPES:
        assert sources.ensure_table(spark, f"staging.src_{name}", CANONICAL_SCHEMA).isEmpty()
        sources.ensure_table(spark, f"staging.dst_{name}", CANONICAL_SCHEMA)
    moves = {f"staging.src_{n}": f"staging.dst_{n}" for n in EVENT_TYPES}
    assert sources.migrate_if_any(spark, moves) is False
    event = conform(
        spark.createDataFrame([("u", "cart"), (None, "cart")], "user_id string, event_type string"),
        CANONICAL_SCHEMA,
    )
    event.write.insertInto("staging.src_cart")
    assert sources.migrate_if_any(spark, moves) is True
    assert spark.table("staging.dst_cart").count() == 1
    sources.migrate_if_any(spark, moves)
    assert spark.table("staging.dst_cart").count() == 1
    sources.migrate_if_any(spark, moves, append=True)
    assert spark.table("staging.dst_cart").count() == 2
    assert sources.copy_table(spark, "staging.src_cart", "staging.copied").count() == 2
    names = sources.describe_tables(spark, "staging")
    assert names.where("table_name = 'copied'").count() == len(CANONICAL_SCHEMA)
    assert sources.read_columns(spark, "staging.copied", ["user_id"]).columns == ["user_id"]


def test_profile_ids(spark):
    profiles = spark.createDataFrame(
        [("12", 1), ("user_1", 2), (None, 3)], "user_id string, total_purchases int"
    )
    full = profiles
    for name in ("favorite_brand", "most_viewed_category", "total_spend", "last_seen_date"):
        full = full.withColumn(name, F.lit(None).cast("string"))
    moved = sources.migrate_profiles(full).collect()
    assert sorted(str(r.user_id) for r in moved) == ["12", "None"]
    kept = sources.migrate_profiles(full, text_id="source_id").collect()
    assert sorted(r.source_id for r in kept) == ["12", "user_1"]


def test_column_case(spark):
    df = spark.range(1).toDF("Id")
    assert lower_columns(df).columns == ["id"] and upper_columns(df).columns == ["ID"]


def test_conform_fills_and_orders(spark):
    df = spark.createDataFrame([("x", "1.5")], "brand string, price string")
    full = conform(df, CANONICAL_SCHEMA)
    assert full.columns == CANONICAL_SCHEMA.names
    assert full.first().price == 1.5 and full.first().user_id is None


@pytest.mark.parametrize("event_type", EVENT_TYPES)
def test_roundtrip_keeps_types(spark, data, event_type):
    events = star_schema.clickstream(spark, data).where(F.col("event_type") == event_type)
    wanted = conform(events, LAKE_SCHEMA)
    assert rows(sources.decode_events(sources.encode_events(events))) == rows(wanted)


MESSAGES = [
    ('{"event_type":"view","user_id":"u1","price":"x"}', None),
    ('{"event_type":"view","user_id":""}', sources.codec.NO_USER),
    ('{"event_type":"view"}', sources.codec.NO_USER),
    ('{"event_type":"view","user_id":"u2"', sources.codec.NOT_JSON),
    ("broken", sources.codec.NOT_JSON),
    ("", sources.codec.NOT_JSON),
    ("  ", sources.codec.NOT_JSON),
    (None, sources.codec.NOT_JSON),
    ("[1, 2]", sources.codec.NOT_JSON),
    ('{"user_id":"u3","more":1}', None),
]


def test_every_message_is_taken_or_kept_with_its_reason(spark):
    frame = spark.createDataFrame([(m,) for m, _ in MESSAGES], "value string")
    judged = sources.judge_messages(frame)
    assert rows(judged.select("raw", "reason")) == rows(spark.createDataFrame(MESSAGES, "raw string, reason string"))
    taken = sources.accepted_events(judged)
    assert taken.schema == sources.decode_events(frame).schema
    assert {r.user_id for r in taken.collect()} == {"u1", "u3"} and taken.where("price is not null").isEmpty()
    assert sources.rejected_messages(judged).count() + taken.count() == len(MESSAGES)


def test_csv_headers_of_many_files(spark, tmp_path):
    import gzip

    (tmp_path / "a b.csv").write_text("\ufeffuser_id,price\nu1,1\n")
    with gzip.open(tmp_path / "c.csv.gz", "wt") as file:
        file.write("price,user_id\n2,u2\n")
    (tmp_path / "d.csv").write_text("user_id,price\n")
    for i in range(20):
        (tmp_path / f"e{i}.csv").write_text(f"price,brand,user_id\n{i},b,v{i}\n")
    found = sources.read_events_csv(spark, str(tmp_path))
    wanted = [("u1", "1"), ("u2", "2")] + [(f"v{i}", str(i)) for i in range(20)]
    assert rows(found.select("user_id", "price")) == sorted(wanted)


def test_csv_fields_over_lines(spark, tmp_path):
    given = spark.createDataFrame([("u1", 'a\n"b",\r\nc'), ("u2", "plain"), ("u3", None)], "user_id string, brand string")
    given.write.option("header", True).option("escape", '"').csv(str(tmp_path / "dump"))
    found = sources.read_events_csv(spark, str(tmp_path / "dump"), multi_line=True)
    assert rows(found.select("user_id", "brand")) == rows(given)

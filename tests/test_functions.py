from __future__ import annotations

from conftest import rows
from pyspark.sql import functions as F

from clickmart import functions as fn


def one(spark, column, **values):
    columns = [F.lit(v).alias(k) for k, v in values.items()]
    return spark.range(1).select(*columns).select(column.alias("x")).first().x


def test_safe_int(spark):
    cases = {
        "12": 12,
        "12.9": 12,
        "-12.9": -12,
        " 7 ": 7,
        "prod_1": 0,
        "": 0,
        "1d": 0,
        "nan": 0,
        "Infinity": 0,
        "12345678901": 0,
        "1234567890": 1234567890,
        "1e3": 1000,
    }
    for text, expected in cases.items():
        assert one(spark, fn.safe_int(F.col("c")), c=text) == expected, text
    null = F.lit(None).cast("string")
    assert spark.range(1).select(fn.safe_int(null).alias("x")).first().x == 0


def test_safe_numbers_of_doubles(spark):
    cases = {12345678.0: 12345678, 123456789.0: 0, -1234567.0: -1234567, 12345678.5: 12345678, 12345678.25: 0}
    for value, expected in cases.items():
        assert one(spark, fn.safe_int(F.col("c")), c=value) == expected, value
    assert one(spark, fn.safe_int(F.col("c")), c="1.2345678E7") == 0
    assert one(spark, fn.safe_float(F.col("c")), c=123456789012345.0) == 123456789012345.0


def test_half_cents_round_away_from_zero(spark):
    for price, expected in {0.125: 13, 1.005: 101, -0.125: -13, 2.0: 200}.items():
        assert one(spark, fn.cents(F.col("c")), c=price) == expected


def test_safe_float(spark):
    cases = {"12.5": 12.5, "abc": 0.0, "": 0.0, "1" * 21: 0.0, "-0.5": -0.5, "NaN": 0.0}
    for text, expected in cases.items():
        assert one(spark, fn.safe_float(F.col("c")), c=text) == expected, text


def test_segment_bounds(spark):
    cases = {1000.0: "VIP", 999.99: "Premium", 500.0: "Premium", 100.0: "Regular", 99.0: "New"}
    for spend, expected in cases.items():
        assert one(spark, fn.segment(F.col("c")), c=spend) == expected
    null = F.lit(None).cast("double")
    assert spark.range(1).select(fn.segment(null).alias("x")).first().x == "New"


def test_minutes_and_days_count_boundaries(spark):
    start = F.lit("2024-01-01 23:59:59").cast("timestamp")
    end = F.lit("2024-01-02 00:00:00").cast("timestamp")
    row = spark.range(1).select(
        fn.minute_diff(start, end).alias("m"),
        fn.day_diff(start, end).alias("d"),
        fn.minute_diff(end, start).alias("back"),
    ).first()
    assert (row.m, row.d, row.back) == (1, 1, -1)


def test_ratio_and_defaults(spark):
    assert one(spark, fn.guarded_ratio(F.col("n"), F.col("d")), n=3, d=0) == 0.0
    assert one(spark, fn.guarded_ratio(F.col("n"), F.col("d")), n=3, d=4) == 75.0
    assert one(spark, fn.default_text(F.col("c"), "unknown"), c="") == "unknown"
    assert one(spark, fn.default_text(F.col("c"), "unknown"), c="x") == "x"
    assert one(spark, fn.pad_id("user_", F.col("c")), c=7) == "user_0007"
    assert one(spark, fn.pad_id("user_", F.col("c")), c=123456) == "user_123456"
    assert one(spark, fn.pick(["a", "b"], F.col("c")), c=3) == "b"


def test_money_is_exact_in_any_order(spark):
    prices = spark.createDataFrame([(0.1,), (0.2,), (1e9,), (0.7,)] * 50, "price double")
    row = prices.agg(
        fn.money_sum(F.col("price")).alias("s"), fn.money_avg(F.col("price")).alias("a")
    ).first()
    assert row.s == 50_000_000_050.0
    assert row.a == 50_000_000_050.0 / 200
    none = prices.where("price < 0").agg(fn.money_avg(F.col("price")).alias("a")).first()
    assert none.a is None


def test_strength(spark):
    cases = {"view": 1, "cart": 2, "purchase": 3, "like": 4, "other": None}
    for kind, expected in cases.items():
        assert one(spark, fn.strength(F.col("c")), c=kind) == expected


def test_sql_helpers(spark):
    assert len(fn.register_helpers(spark)) == 3
    row = spark.sql(
        "SELECT spend_segment(700) a, interaction_strength('cart') b, whole_number('4.9') c, "
        "whole_number('x') d, whole_number('1d') e"
    ).first()
    assert tuple(row) == ("Premium", 2, 4, 0, 0)


def test_parameters_as_variant(spark, tmp_path):
    from clickmart.functions import parameter, with_json, with_variant

    texts = [("a", '{"n": 10, "deep": {"x": [1, 2]}, "name": "als"}'), ("b", '{"n": "many"}'), ("c", "no json"), ("d", None), ("e", "[1]")]
    models = spark.createDataFrame(texts, "model string, parameters string")
    with_variant(models, "parameters").write.parquet(str(tmp_path / "models"))
    stored = spark.read.parquet(str(tmp_path / "models"))
    assert stored.schema["parameters"].dataType.simpleString() == "variant"
    assert rows(stored.where(parameter("parameters", "$.n", "int") == 10).select("model")) == [("a",)]
    assert rows(stored.select("model", parameter("parameters", "$.deep.x[1]", "int"))) == [("a", 2), ("b", None), ("c", None), ("d", None), ("e", None)]
    back = {r["model"]: r["parameters"] for r in with_json(stored, "parameters").collect()}
    assert back == {"a": '{"deep":{"x":[1,2]},"n":10,"name":"als"}', "b": '{"n":"many"}', "c": None, "d": None, "e": "[1]"}

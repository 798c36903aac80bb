from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from clickmart.plans import category_recs, daily_store, marts
from clickmart.sources import star_schema


@pytest.fixture(scope="module")
def events(spark, data):
    return star_schema.clickstream(spark, data)


def test_spans_equal_the_exact_marts(spark, events, tmp_path):
    root = str(tmp_path / "category")
    daily_store.replace_days(daily_store.funnel_parts(events, "category_code"), root)
    inside = (F.col("event_time") >= "2024-01-05") & (F.col("event_time") < "2024-01-09")
    counts = ["unique_users", "unique_products"]
    for found, exact in (
        (daily_store.category_performance(spark, root), marts.category_performance(events)),
        (daily_store.category_performance(spark, root, "2024-01-05", "2024-01-09"), marts.category_performance(events.where(inside))),
    ):
        assert rows(found.drop(*counts)) == rows(exact.drop(*counts))
    assert daily_store.category_performance(spark, root, "2031-01-01").collect() == []


def test_top_products_after_daily_merges(spark, events, tmp_path):
    root = str(tmp_path / "sales")
    days = [r[0] for r in events.select(F.to_date("event_time")).distinct().orderBy(F.to_date("event_time")).limit(3).collect()]
    seen = []
    for day in [*days, days[1]]:  # the second day comes again
        daily_store.replace_days(daily_store.sales_parts(events.where(F.to_date("event_time") == F.lit(day))), root)
        seen = sorted({*seen, day})
        full = category_recs.category_top_products(events.where(F.to_date("event_time").isin(seen)))
        assert rows(daily_store.category_top_products(spark, root)) == rows(full)


def test_events_without_a_time_are_a_day_of_their_own(spark, tmp_path):
    schema = "user_id string, event_type string, product_id string, category_code string, price double, event_time timestamp"
    odd = spark.createDataFrame([("u", "purchase", "p", "c", 0.125, None), (None, "view", None, "c", None, None), ("u", "view", "p", None, 1.0, None)], schema)
    root = str(tmp_path / "category")
    for _ in range(2):
        daily_store.replace_days(daily_store.funnel_parts(odd, "category_code"), root)
    assert rows(daily_store.category_performance(spark, root)) == rows(marts.category_performance(odd))
    daily_store.replace_days(daily_store.funnel_parts(odd.where("false"), "category_code"), root)
    assert daily_store.category_performance(spark, root).count() == 1


def test_estimates_of_many_users(spark, tmp_path):
    many = spark.range(300_000).selectExpr(
        "concat('u', id % 200000) AS user_id", "'view' AS event_type", "concat('p', id % 50) AS product_id",
        "1.0D AS price", "timestamp'2024-01-01' + make_interval(0, 0, 0, int(id % 3)) AS event_time",
    )
    root = str(tmp_path / "days")
    daily_store.replace_days(daily_store.funnel_parts(many), root)
    found = daily_store.active_users(spark, root).first()
    assert found["total_events"] == 300_000 and abs(found["users"] - 200_000) <= 0.03 * 200_000
    one = daily_store.active_users(spark, root, "2024-01-02", "2024-01-03").first()
    assert one["total_events"] == 100_000 and abs(one["users"] - 100_000) <= 0.03 * 100_000
    plan = daily_store.active_users(spark, root, "2024-01-02", "2024-01-03")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan

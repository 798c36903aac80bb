from __future__ import annotations

import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from clickmart.plans import category_recs, marts, profiles, recommend, warehouse
from clickmart.schema import CANONICAL_SCHEMA, DAILY_METRICS_SCHEMA, conform
from clickmart.sources import star_schema

FIELDS = "user_id string, event_time string, event_type string, product_id string, " \
    "price double, brand string, category_code string"


def events(spark, *data):
    return conform(spark.createDataFrame(list(data), FIELDS), CANONICAL_SCHEMA)


@pytest.fixture(scope="module")
def clicks(spark, data):
    return star_schema.clickstream(spark, data)


def test_profile_rules(spark):
    df = events(
        spark,
        ("u1", "2024-01-01", "purchase", "p1", 10.0, "beta", "c1"),
        ("u1", "2024-01-02", "purchase", "p2", 10.0, "alpha", "c1"),
        ("u1", "2024-01-03", "view", "p1", 5.0, "x", "c2"),
        ("u1", "2024-01-04", "view", "p1", 5.0, None, "c1"),
        ("u1", "2024-01-05", "view", "p1", 5.0, None, "c1"),
        ("u1", "2024-01-09", "cart", "p1", None, "x", "c9"),
        ("u2", "2024-01-01", "view", "p1", 1.0, None, None),
        (None, "2024-01-01", "purchase", "p1", 1.0, "b", "c"),
        ("u3", "2024-01-01", "purchase", "p1", None, "b", "c"),
    )
    ranked = {r.user_id: r for r in profiles.customer_360(df).collect()}
    assert set(ranked) == {"u1", "u2"}
    one = ranked["u1"]
    assert (one.favorite_brand, one.most_viewed_category) == ("alpha", "c1")
    assert (one.total_purchases, one.total_spend) == (2, 20.0)
    assert one.last_seen_date == datetime.datetime(2024, 1, 5)
    two = ranked["u2"]
    assert two.total_purchases is None and two.total_spend is None and two.favorite_brand is None
    by_mode = {r.user_id: r for r in profiles.customer_360(df, "mode").collect()}
    assert set(by_mode) == {"u1"} and by_mode["u1"].most_viewed_category == "c2"
    by_name = {r.user_id: r for r in profiles.customer_360(df, "max").collect()}
    assert set(by_name) == {"u1", "u2", "u3"}
    assert by_name["u1"].favorite_brand == "beta" and by_name["u2"].total_spend == 0.0
    assert by_name["u1"].last_seen_date == datetime.datetime(2024, 1, 9)
    with pytest.raises(ValueError):
        profiles.customer_360(df, "first")


def test_segments_partition_the_users(spark, clicks):
    profile = profiles.customer_360(clicks)
    segments = profiles.user_segments(profile)
    spread = profiles.segment_distribution(segments)
    assert spread.agg(F.sum("user_count")).first()[0] == profile.count()
    poor = spark.createDataFrame(
        [("u", None)], "user_id string, total_spend double"
    )
    for name in ("total_purchases", "favorite_brand", "most_viewed_category", "last_seen_date"):
        poor = poor.withColumn(name, F.lit(None).cast("string"))
    assert profiles.user_segments(poor).first().segment == "New"


def test_combined_rows_and_revenue_add_up(clicks):
    gaps = F.when(F.col("event_id") % 11 != 0, F.col("category_code"))
    parts = warehouse.staging(clicks.withColumn("category_code", gaps))
    combined = marts.combined_events(*parts.values())
    assert combined.count() == sum(df.count() for df in parts.values())
    daily = marts.daily_performance(combined).agg(F.sum("daily_revenue")).first()[0]
    category = marts.category_performance(combined).agg(F.sum("total_revenue")).first()[0]
    lost = combined.where("event_type = 'purchase' AND category_code IS NULL")
    lost = lost.agg(F.sum("price")).first()[0]
    assert daily == pytest.approx(category + lost, abs=0.001)
    journey = marts.user_journey(combined).agg(F.sum("event_count")).first()[0]
    assert journey == combined.where("user_id IS NOT NULL").count()


def test_empty_groups_and_days(spark):
    df = events(
        spark,
        ("u1", "2024-01-01 23:59:30", "view", "p1", None, "b", "c"),
        ("u1", "2024-01-02 00:00:10", "view", "p2", None, None, "c"),
        ("u2", "2024-01-02", "purchase", "p2", 3.0, "b", "c"),
    )
    behavior = {r.user_id: r for r in marts.user_behavior(df).collect()}
    assert behavior["u1"].total_spend == 0.0 and behavior["u1"].avg_purchase_value is None
    assert behavior["u1"].days_active == 1 and behavior["u1"].view_to_purchase_ratio == 0.0
    journey = {(r.user_id, r.event_type): r for r in marts.user_journey(df).collect()}
    assert journey[("u1", "view")].session_duration_minutes == 1
    empty = marts.metrics_for_day(df, "2023-01-01").first()
    assert (empty.total_users, empty.total_purchases, empty.conversion_rate) == (0, 0, 0.0)
    day = marts.metrics_for_day(df, "2024-01-02").first()
    assert (day.total_users, day.total_purchases, day.conversion_rate) == (2, 1, 50.0)


def test_refreshing_a_day_twice_changes_nothing(spark, clicks):
    empty = spark.createDataFrame([], DAILY_METRICS_SCHEMA)
    once = warehouse.refresh_daily_metrics(empty, clicks, "2024-01-05")
    twice = warehouse.refresh_daily_metrics(once, clicks, "2024-01-05")
    assert once.count() == 1 and rows(once) == rows(twice)
    two_days = warehouse.refresh_daily_metrics(twice, clicks, "2024-01-06")
    assert two_days.count() == 2


def test_affinity_keeps_direction_and_users_apart(spark):
    df = events(
        spark,
        ("u1", "2024-01-01", "purchase", "a", 1.0, None, None),
        ("u1", "2024-01-02", "purchase", "b", 1.0, None, None),
        ("u1", "2024-01-03", "purchase", "b", 1.0, None, None),
        ("u1", "2024-01-04", "purchase", "a", 1.0, None, None),
        ("u1", "2024-01-05", "view", "z", 1.0, None, None),
        ("u2", "2024-01-01", "purchase", "a", 1.0, None, None),
        ("u2", "2024-01-02", "purchase", "b", 1.0, None, None),
        ("u2", "2024-01-03", "purchase", None, 1.0, None, None),
        (None, "2024-01-01", "purchase", "x", 1.0, None, None),
        (None, "2024-01-02", "purchase", "y", 1.0, None, None),
    )
    expected = [("a", "b", 2), ("b", "a", 1), ("x", "y", 1)]
    assert rows(marts.product_affinity(df)) == expected
    assert rows(marts.product_affinity(df, ranges=3)) == expected


def test_product_with_two_brands_is_one_row(spark):
    df = events(
        spark,
        ("u1", "2024-01-01", "view", "p", None, "z", "c2"),
        ("u2", "2024-01-01", "view", "p", None, "a", "c1"),
        ("u1", "2024-01-01", "purchase", "p", 4.0, None, None),
        ("u1", "2024-01-01", "cart", "q", None, "a", None),
    )
    parts = warehouse.staging(df)
    products = marts.product_analytics(parts["view"], parts["cart"], parts["purchase"])
    by_id = {r.product_id: r for r in products.collect()}
    assert (by_id["p"].brand, by_id["p"].category_code) == ("a", "c1")
    assert (by_id["p"].unique_viewers, by_id["p"].conversion_rate) == (2, 0.5)
    assert (by_id["q"].avg_price, by_id["q"].conversion_rate) == (0.0, 0.0)
    brand = marts.brand_analytics(products, parts["purchase"]).first()
    assert (brand.total_products, brand.avg_product_price, brand.unique_customers) == (2, 2.0, 0)
    catalog = marts.product_catalog(df, "2024-02-01")
    assert catalog.where("product_id = 'p'").count() == 3


def test_category_recommendations(spark):
    df = events(
        spark,
        *[("u1", "2024-01-01", "purchase", "p2", 1.0, None, "c")] * 2,
        *[("u1", "2024-01-01", "purchase", "p1", 1.0, None, "c")] * 2,
        ("u1", "2024-01-01", "purchase", "p3", 9.0, None, "c"),
        ("u1", "2024-01-01", "purchase", "p9", 1.0, None, None),
    )
    top = category_recs.category_top_products(df, k=2)
    assert top.first().recommended_products == ["p1", "p2"]
    more = category_recs.category_top_products(df, k=5).first()
    assert more.recommended_products == ["p1", "p2", "p3"]
    assert more.recommendation_score == pytest.approx(5 / 3)
    pricey = df.withColumn("price", F.when(F.col("product_id") == "p2", 7.0).otherwise(1.0))
    by_price = category_recs.category_top_products(pricey, tie_break="avg_price").first()
    assert by_price.recommended_products[:2] == ["p2", "p1"]
    profile = spark.createDataFrame(
        [("u1", "c"), ("u2", None), ("u3", "other")], "user_id string, most_viewed_category string"
    )
    recs = category_recs.recommend_by_category(profile, top, "2024-02-01")
    flat = category_recs.flat_recommendations(recs)
    assert rows(flat.select("user_id", "product_id", "rank")) == [("u1", "p1", 1), ("u1", "p2", 2)]


def test_build_warehouse(spark, clicks, tmp_path):
    lake, out = str(tmp_path / "lake"), str(tmp_path / "out")
    clicks.write.partitionBy("event_type").parquet(lake)
    counts = {r.table_name: r.row_count for r in warehouse.build_warehouse(
        spark, lake, out, "2024-02-01"
    ).collect()}
    assert counts["combined_events"] == warehouse.staged(clicks).count() < clicks.count()
    assert counts["customer_360"] == clicks.select("user_id").distinct().count()
    assert counts["customer_360"] == counts["user_segments"]
    assert counts["product_features"] == counts["product_analytics"]
    assert counts["recommendation_performance"] == counts["product_features"]
    users = clicks.where("product_id IS NOT NULL").select("user_id").distinct().count()
    assert 0 < counts["user_behavior_features"] == counts["recommendation_summary"] <= users
    assert counts["flat_recommendations"] <= 5 * counts["category_recommendations"]
    again = {r.table_name: r.row_count for r in warehouse.build_warehouse(
        spark, lake, out, "2024-02-01"
    ).collect()}
    assert counts == again


def test_approximate_counts_come_close(clicks):
    combined = warehouse.staged(clicks)
    for mart, key, users in (
        (marts.category_performance, "category_code", "unique_users"),
        (marts.brand_performance, "brand", "unique_customers"),
    ):
        exact = {r[key]: r for r in mart(combined).collect()}
        near = {r[key]: r for r in mart(combined, approx=True).collect()}
        assert exact.keys() == near.keys()
        for name, row in exact.items():
            assert abs(row[users] - near[name][users]) <= 0.15 * row[users] + 1
            assert row["total_revenue"] == near[name]["total_revenue"]


def test_product_features_take_the_rating_as_given(spark):
    catalogue = spark.createDataFrame(
        [("p1", "b", "c", 1.0, 4.5), ("p2", "b", "c", 2.0, None)],
        "product_id string, brand string, category_code string, price double, avg_rating double",
    )
    events = spark.createDataFrame(
        [("p1", "purchase"), ("p1", "view"), (None, "purchase"), (None, "purchase")],
        "product_id string, event_type string",
    )
    found = {r.product_id: r for r in recommend.product_features(catalogue, events).collect()}
    assert (found["p1"].avg_rating, found["p1"].popularity_score, found["p1"].total_reviews) == (4.5, 1.0, 1)
    assert (found["p2"].avg_rating, found["p2"].popularity_score) == (None, 0.0)
    unsold = recommend.product_features(catalogue, events.where("event_type = 'view'")).collect()
    assert {r.popularity_score for r in unsold} == {0.0}


def test_product_affinity_has_tasks_by_rows(spark, monkeypatch):
    """More rows are more tasks of the same size, for the steps and for their counts."""
    monkeypatch.setattr("clickmart.operators.ordered.ROWS_OF_RANGE", 50)
    bought = spark.range(1000).selectExpr(
        "concat('u', id % 7) AS user_id", "'purchase' AS event_type", "concat('p', id * 31 % 90) AS product_id",
        "timestamp'2024-01-01' AS event_time", "id AS event_id",
    )
    plan = marts.product_affinity(bought)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and ", 20), REPARTITION_BY_NUM" in plan
    monkeypatch.undo()
    assert rows(marts.product_affinity(bought, ranges=20)) == rows(marts.product_affinity(bought, ranges=1))

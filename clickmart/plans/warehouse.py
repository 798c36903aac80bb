"""Refresh jobs and the whole warehouse build."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.operators.quality import check_unique, observed
from clickmart.operators.upsert import upsert
from clickmart.plans import marts, profiles, recommend, similarity
from clickmart.plans.category_recs import (
    category_top_products,
    flat_recommendations,
    recommend_by_category,
)
from clickmart.schema import EVENT_TYPES, to_canonical
from clickmart.sinks.tables import read_version, write_version
from clickmart.sources.files import read_lake
from clickmart.sources.tables import migrate_events

_DAILY_COLUMNS = [
    "total_users",
    "total_purchases",
    "total_revenue",
    "avg_order_value",
    "conversion_rate",
]


def refresh_daily_metrics(target: DataFrame, events: DataFrame, as_of: str) -> DataFrame:
    """The daily table with one day computed anew. Write it with ``write_version``."""
    return upsert(target, marts.metrics_for_day(events, as_of), ["metric_date"], _DAILY_COLUMNS)


def refresh_recommendations(profile: DataFrame, events: DataFrame, as_of: str) -> DataFrame:
    """All category recommendations anew, replacing the old ones in one atomic write."""
    return recommend_by_category(profile, category_top_products(events), as_of)


def staging(lake: DataFrame) -> dict[str, DataFrame]:
    """One frame per event type that has a staging table; each reads its own lake partition."""
    return {name: lake.where(F.col("event_type") == name) for name in EVENT_TYPES}


def staged(lake: DataFrame) -> DataFrame:
    """The events of all staging tables in one scan: the lake without types that have no such table."""
    return lake.where(F.col("event_type").isin(EVENT_TYPES))


def build_warehouse(
    spark: SparkSession,
    lake: str,
    out: str,
    as_of: str,
    k: int = 5,
    neighbors: int = 20,
    ratings: DataFrame | None = None,
) -> DataFrame:
    """Build every table from the lake in dependency order; table_name, row_count and null_counts of each.

    ``null_counts`` has the number of NULLs of every column. Both are counted while a table is written, without reading
    it again.

    Events hold no ratings: give ``ratings`` (``product_id``, ``avg_rating``), or the ratings and the content
    scores made of them stay NULL.
    Each table is written once, as a new version beside the old ones, and its dependants read the
    written files. Readers keep the version that they have; ``read_version`` finds the newest.
    """
    counted: list[tuple[str, int, dict[str, int]]] = []

    def save(name: str, df: DataFrame, partition: str | None = None) -> DataFrame:
        rows, seen = observed(df)
        version = write_version(rows, f"{out}/{name}", partition)
        counted.append((name, seen.get["row_count"], seen.get["nulls"].asDict()))
        return spark.read.schema(df.schema).parquet(f"{out}/{name}/version={version}")

    everything = read_lake(spark, lake)
    parts = [migrate_events(to_canonical(df)) for df in staging(everything).values()]
    events = save("combined_events", marts.combined_events(*parts), "event_type")
    by_type = staging(events)

    profile = save("customer_360", profiles.customer_360(to_canonical(everything)))
    behavior = save("user_behavior", marts.user_behavior(events))
    save("product_popularity", marts.product_popularity(events))
    save("category_performance", marts.category_performance(events))
    save("daily_performance", marts.daily_performance(events))
    save("daily_metrics", marts.daily_metrics(events))
    save("brand_performance", marts.brand_performance(events))
    save("user_journey", marts.user_journey(events))
    save("product_affinity", marts.product_affinity(events))
    save("product_catalog", marts.product_catalog(events, as_of))

    segments = save("user_segments", profiles.user_segments(profile))
    save("user_activity_segments", profiles.user_segments_with_activity(behavior, profile))
    save("segment_export", profiles.segment_export(events, segments, as_of))

    top = category_top_products(events, k, "avg_price")
    recommendations = save(
        "category_recommendations", recommend_by_category(profile, top, as_of)
    )
    flat = save("flat_recommendations", flat_recommendations(recommendations))

    products = save(
        "product_analytics",
        marts.product_analytics(by_type["view"], by_type["cart"], by_type["purchase"]),
    )
    save("brand_analytics", marts.brand_analytics(products, by_type["purchase"]))
    save("category_analytics", marts.category_analytics(products, by_type["purchase"]))

    interactions = save(
        "user_product_interactions", similarity.interactions_from_events(events)
    )
    features = save(
        "user_behavior_features",
        profiles.with_favorites(profiles.user_behavior_features(interactions), profile),
    )
    catalogue = products.select(
        "product_id", "brand", "category_code", F.col("avg_price").alias("price")
    )
    if ratings is None:
        catalogue = catalogue.withColumn("avg_rating", F.lit(None).cast("double"))
    else:
        catalogue = catalogue.join(ratings.select("product_id", "avg_rating"), "product_id", "left")
    rated = save("product_features", recommend.product_features(catalogue, events))
    near = save("similar_users", similarity.similar_users(interactions, neighbors))
    content = save("content_recommendations", recommend.content_based(features, rated))
    save(
        "collaborative_recommendations",
        recommend.collaborative(interactions, neighborhood=near),
    )
    known_too = recommend.collaborative(interactions, exclude_seen=False, neighborhood=near)
    save("hybrid_recommendations", recommend.hybrid(content, known_too))
    save(
        "popularity_recommendations", recommend.popularity_recs(features, rated, interactions)
    )
    outcomes = recommend.mark_outcomes(flat, events)
    save("recommendation_summary", recommend.recommendation_summary(features, outcomes))
    save("recommendation_performance", recommend.recommendation_performance(rated, outcomes))
    return spark.createDataFrame(counted, "table_name string, row_count long, null_counts map<string,long>")


# Columns that identify a row of a table; without NULLs where a table says nothing else.
KEYS = {
    "customer_360": ["user_id"],
    "user_behavior": ["user_id"],
    "product_popularity": ["product_id", "category_code"],
    "category_performance": ["category_code"],
    "daily_performance": ["event_date"],
    "daily_metrics": ["metric_date"],
    "brand_performance": ["brand"],
    "user_journey": ["user_id", "event_type"],
    "product_affinity": ["product_1", "product_2"],
    "user_segments": ["user_id"],
    "product_analytics": ["product_id"],
    "brand_analytics": ["brand"],
    "category_analytics": ["category_code"],
    "user_product_interactions": ["user_id", "product_id", "interaction_type", "interaction_time"],
    "user_behavior_features": ["user_id"],
    "product_features": ["product_id"],
    "similar_users": ["user_id", "similar_user_id"],
    "content_recommendations": ["user_id", "product_id"],
    "collaborative_recommendations": ["user_id", "product_id"],
    "hybrid_recommendations": ["user_id", "product_id"],
    "popularity_recommendations": ["user_id", "product_id"],
    "recommendation_summary": ["user_id"],
    "recommendation_performance": ["product_id"],
}


def check_warehouse(spark: SparkSession, out: str, built: DataFrame) -> DataFrame:
    """One row for each table of ``KEYS``: whether it has rows, NULLs in its key, and keys that it holds twice.

    ``built`` is what ``build_warehouse`` returned, which answers the first two; only the keys are read.
    """
    nothing = F.lit(0).cast("long")
    repeated = [
        check_unique(read_version(spark, f"{out}/{name}").select(*keys), keys)
        .agg(F.count("*").alias("repeated_keys"))
        .select(F.lit(name).alias("table_name"), "repeated_keys")
        for name, keys in KEYS.items()
    ]
    of_key = F.create_map(*[x for name, keys in KEYS.items() for x in (F.lit(name), F.array(*map(F.lit, keys)))])
    nulls = F.aggregate(of_key[F.col("table_name")], nothing, lambda n, c: n + F.col("null_counts")[c])
    return reduce(DataFrame.unionByName, repeated).join(built, "table_name").select(
        "table_name", (F.col("row_count") > 0).alias("has_rows"), nulls.alias("null_keys"), "repeated_keys"
    )

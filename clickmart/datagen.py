"""Made-up events and recommender tables for demonstrations. Same seed, same rows."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.functions import pad_id, pick, strength
from clickmart.operators.upsert import insert_ignore
from clickmart.schema import INTERACTION_SCHEMA, MODEL_SCHEMA, to_canonical

# Names the demonstration data is drawn from.
BRANDS = ["Nike", "Adidas", "Apple", "Samsung", "Sony"]
CATEGORIES = ["electronics", "clothing", "sports", "home", "books"]

# The sample models (name, type, algorithm, score).
MODELS = [
    ("Collaborative Filtering", "collaborative", "user_based", Decimal("0.85")),
    ("Content Based", "content_based", "category_similarity", Decimal("0.78")),
    ("Hybrid Model", "hybrid", "ensemble", Decimal("0.92")),
]


def _draw(name: str, seed: int, n: int) -> Column:
    """Whole number below ``n`` for a row, by hash, so it does not depend on partitioning."""
    return F.pmod(F.xxhash64("id", F.lit(name), F.lit(seed)), F.lit(n))


def _amount(name: str, seed: int, low: float, high: float, digits: int = 2) -> Column:
    steps = int(round((high - low) * 10**digits))
    return F.round(F.lit(low) + _draw(name, seed, steps + 1) / 10**digits, digits)


def _rows(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n)


def demo_events(
    spark: SparkSession,
    carts: int = 50,
    purchases: int = 30,
    views: int = 70,
    as_of: str = "2025-01-31",
    seed: int = 0,
) -> DataFrame:
    """Events of the last 30 days with the gaps real ones have.

    Carts carry no price and no category, purchases no category, views only a category.
    """
    parts = []
    for offset, (event_type, n) in enumerate(
        {"cart": carts, "purchase": purchases, "view": views}.items()
    ):
        own = seed * 3 + offset
        brand = F.when(_draw("has brand", own, 2) == 0, pick(BRANDS, _draw("brand", own, 5)))
        rows = _rows(spark, n).select(
            F.concat(F.lit("user_"), (_draw("user", own, 9000) + 1000).cast("string")).alias(
                "user_id"
            ),
            F.date_sub(F.lit(as_of).cast("date"), _draw("day", own, 31).cast("int")).alias(
                "event_time"
            ),
            F.lit(event_type).alias("event_type"),
            F.concat(F.lit("prod_"), (_draw("product", own, 90000) + 10000).cast("string")).alias(
                "product_id"
            ),
            (_amount("price", own, 10, 500) if event_type == "purchase" else F.lit(None)).alias(
                "price"
            ),
            (F.lit(None) if event_type == "view" else brand).alias("brand"),
            (
                pick(CATEGORIES, _draw("category", own, 5))
                if event_type == "view"
                else F.lit(None)
            ).alias("category_code"),
        )
        parts.append(to_canonical(rows))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def sample_recommender(
    spark: SparkSession,
    users: int = 100,
    products: int = 50,
    interactions: int = 1000,
    as_of: str = "2025-01-31 00:00:00",
    seed: int = 0,
) -> dict[str, DataFrame]:
    """User features, product features, interactions and models."""
    features = _rows(spark, users).select(
        pad_id("user_", F.col("id")).alias("user_id"),
        (_draw("views", seed, 191) + 10).alias("total_views"),
        _draw("purchases", seed, 21).alias("total_purchases"),
        _amount("spend", seed, 0, 1000).alias("total_spend"),
        pick(CATEGORIES, _draw("category", seed, 5)).alias("favorite_category"),
        pick(BRANDS, _draw("brand", seed, 5)).alias("favorite_brand"),
        _amount("frequency", seed, 0.1, 5).alias("purchase_frequency"),
        _amount("order value", seed, 10, 100).alias("avg_order_value"),
    )
    catalogue = _rows(spark, products).select(
        pad_id("product_", F.col("id")).alias("product_id"),
        pick(BRANDS, _draw("product brand", seed, 5)).alias("brand"),
        pick(CATEGORIES, _draw("product category", seed, 5)).alias("category_code"),
        _amount("product price", seed, 10, 500).alias("price"),
        _amount("rating", seed, 1, 5).alias("avg_rating"),
        _draw("reviews", seed, 101).alias("total_reviews"),
        _amount("popularity", seed, 0, 1, 4).alias("popularity_score"),
    )
    kind = pick(["view", "cart", "purchase"], _draw("type", seed, 3))
    minutes = (
        _draw("days", seed, 31) * 1440 + _draw("hours", seed, 25) * 60 + _draw("minutes", seed, 61)
    )
    events = _rows(spark, interactions).select(
        pad_id("user_", _draw("who", seed, users)).alias("user_id"),
        pad_id("product_", _draw("what", seed, products)).alias("product_id"),
        kind.alias("interaction_type"),
        strength(kind).alias("interaction_strength"),
        F.timestamp_seconds(
            F.unix_seconds(F.lit(as_of).cast("timestamp")) - minutes * 60
        ).alias("interaction_time"),
    )
    empty = spark.createDataFrame([], INTERACTION_SCHEMA)
    keys = ["user_id", "product_id", "interaction_type", "interaction_time"]
    models = spark.createDataFrame(
        [
            (i, name, kind_, algorithm, None, score, True)
            for i, (name, kind_, algorithm, score) in enumerate(MODELS, start=1)
        ],
        MODEL_SCHEMA,
    )
    return {
        "user_behavior_features": features,
        "product_features": catalogue,
        "user_product_interactions": insert_ignore(empty, events, keys),
        "recommendation_models": models,
    }

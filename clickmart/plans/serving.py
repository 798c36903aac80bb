"""The lookups and reports that users run against the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def recommendations_of(recommendations: DataFrame, user_id: str) -> DataFrame:
    """Recommendations of one user. On a table sorted by user this prunes by file statistics."""
    return recommendations.where(F.col("user_id") == user_id)


def top_products_of(popularity: DataFrame, category: str, k: int = 10) -> DataFrame:
    return (
        popularity.where(F.col("category_code") == category)
        .orderBy(F.desc("purchase_count"), "product_id")
        .limit(k)
    )


def high_value_users(behavior: DataFrame, min_spend: float = 500) -> DataFrame:
    return behavior.where(F.col("total_spend") > min_spend).orderBy(
        F.desc("total_spend"), "user_id"
    )


def last_days(daily: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Daily figures of the ``days`` days up to ``as_of``."""
    return daily.where(F.col("event_date") >= F.date_sub(F.lit(as_of).cast("date"), days))


def most_popular_products(products: DataFrame, k: int = 10) -> DataFrame:
    return (
        products.select("product_id", "brand", "category_code", "popularity_score", "avg_rating")
        .orderBy(F.desc_nulls_last("popularity_score"), "product_id")
        .limit(k)
    )


def top_spenders(features: DataFrame, k: int = 10) -> DataFrame:
    return (
        features.select("user_id", "favorite_category", "total_purchases", "total_spend")
        .orderBy(F.desc_nulls_last("total_spend"), "user_id")
        .limit(k)
    )


def best_served_users(summary: DataFrame, k: int = 10) -> DataFrame:
    """Users with recommendations, best average score first."""
    return (
        summary.where(F.col("total_recommendations") > 0)
        .orderBy(F.desc_nulls_last("avg_recommendation_score"), "user_id")
        .limit(k)
    )


def strongest_recommendations(recommendations: DataFrame, k: int = 5) -> DataFrame:
    return recommendations.orderBy(
        F.desc_nulls_last("recommendation_score"), "user_id", "product_id"
    ).limit(k)

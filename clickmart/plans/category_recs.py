"""Recommendations from the best sellers of a user's favourite category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.functions import is_type, money_avg
from clickmart.operators.ranking import collect_ranked, top_n

# Fixed value: the reason stored with every recommendation of this kind.
CATEGORY_REASON = "Top products in favorite category"


def category_top_products(
    events: DataFrame, k: int = 5, tie_break: str | None = None
) -> DataFrame:
    """The ``k`` most bought products per category, as an array in rank order.

    Equal counts go by product id, or first by higher average price with ``tie_break="avg_price"``.
    ``recommendation_score`` is the average purchase count of the listed products.
    """
    counts = sales(events).groupBy("category_code", "product_id").agg(
        F.count("*").alias("purchase_count"), money_avg(F.col("price")).alias("avg_price")
    )
    return ranked_products(counts, k, tie_break)


def sales(events: DataFrame) -> DataFrame:
    """Purchases of a known product in a known category."""
    return events.where(
        is_type("purchase") & F.col("category_code").isNotNull() & F.col("product_id").isNotNull()
    )


def ranked_products(counts: DataFrame, k: int = 5, tie_break: str | None = None) -> DataFrame:
    """``category_top_products`` from purchase count and average price per category and product."""
    order = [F.desc("purchase_count"), F.asc("product_id")]
    if tie_break is not None:
        order.insert(1, F.desc_nulls_last(tie_break))
    return (
        top_n(counts, ["category_code"], order, k, "rank")
        .groupBy("category_code")
        .agg(
            collect_ranked("rank", "product_id").alias("recommended_products"),
            F.avg("purchase_count").alias("recommendation_score"),
        )
    )


def recommend_by_category(
    profile: DataFrame, top: DataFrame, as_of: str | None = None
) -> DataFrame:
    """Every user with a favourite category gets its top products.

    The list of categories is small next to the users; the adaptive join broadcasts it when its
    measured size allows and otherwise splits a category that too many users share.
    """
    moment = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    users = profile.where(F.col("most_viewed_category").isNotNull()).select(
        "user_id", F.col("most_viewed_category").alias("category_code")
    )
    return users.join(top, "category_code").select(
        "user_id",
        "recommended_products",
        "recommendation_score",
        F.lit(CATEGORY_REASON).alias("recommendation_reason"),
        moment.alias("recommendation_date"),
    )


def flat_recommendations(recommendations: DataFrame) -> DataFrame:
    """One row per recommended product with its rank."""
    return recommendations.select(
        "user_id",
        "recommendation_score",
        F.posexplode("recommended_products").alias("position", "product_id"),
    ).select(
        "user_id",
        "product_id",
        "recommendation_score",
        (F.col("position") + 1).cast("long").alias("rank"),
    )

"""Customer profiles, segments and user features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.functions import cents, day_diff, is_type, money_avg, money_sum, segment
from clickmart.operators.ranking import best_value


def customer_360(events: DataFrame, favorites: str = "rank") -> DataFrame:
    """Customer profile: favourites, purchases, spend and last activity per user.

    ``favorites`` selects the rules. ``rank`` and ``mode`` drop events without a price (``mode``
    also those without a brand), take the most frequent brand bought and category viewed, smallest
    name among equals, and leave purchases and spend NULL for users who never bought. ``max`` keeps
    every event, takes the alphabetically last names and gives 0 instead of NULL.
    """
    if favorites == "max":
        return _alphabetical_profile(events)
    if favorites not in ("rank", "mode"):
        raise ValueError(f"unknown favorites rule: {favorites}")

    cleaned = events.where(F.col("user_id").isNotNull() & F.col("price").isNotNull())
    if favorites == "mode":
        cleaned = cleaned.where(F.col("brand").isNotNull())

    # An event speaks for at most one favourite: a purchase for its brand, a view for its category.
    # Counting those first reduces every user to a few rows before the second grouping, so neither
    # a scan per favourite nor a join is needed and a heavy user is spread over many tasks.
    choice = F.when(is_type("purchase"), F.col("brand")).when(
        is_type("view"), F.col("category_code")
    )
    kind = F.when(F.col("event_type").isin("purchase", "view"), F.col("event_type"))
    counted = cleaned.groupBy("user_id", kind.alias("kind"), choice.alias("choice")).agg(
        F.count("*").alias("n"),
        F.sum(cents(F.col("price"))).alias("cents"),
        F.max("event_time").alias("last"),
    )
    bought, viewed = F.col("kind") == "purchase", F.col("kind") == "view"
    return counted.groupBy("user_id").agg(
        best_value(F.col("choice"), F.col("n"), bought).alias("favorite_brand"),
        best_value(F.col("choice"), F.col("n"), viewed).alias("most_viewed_category"),
        F.sum(F.when(bought, F.col("n"))).alias("total_purchases"),
        (F.sum(F.when(bought, F.col("cents"))) / F.lit(100.0)).alias("total_spend"),
        F.max("last").alias("last_seen_date"),
    )


def _alphabetical_profile(events: DataFrame) -> DataFrame:
    spend = F.when(is_type("purchase"), cents(F.col("price"))).otherwise(F.lit(0))
    return (
        events.where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.max(F.when(is_type("purchase"), F.col("brand"))).alias("favorite_brand"),
            F.max(F.when(is_type("view"), F.col("category_code"))).alias("most_viewed_category"),
            F.count_if(is_type("purchase")).alias("total_purchases"),
            (F.sum(spend) / F.lit(100.0)).alias("total_spend"),
            F.max("event_time").alias("last_seen_date"),
        )
    )


def user_segments(profile: DataFrame) -> DataFrame:
    """Profiles with their spend segment."""
    return profile.select(
        "user_id",
        "total_spend",
        "total_purchases",
        "favorite_brand",
        "most_viewed_category",
        "last_seen_date",
        segment(F.col("total_spend")).alias("segment"),
    )


def user_segments_with_activity(behavior: DataFrame, profile: DataFrame) -> DataFrame:
    """Segments of every active user: spend and activity from behaviour, the rest from the profile."""
    active = behavior.select("user_id", "total_spend", "days_active")
    known = profile.select(
        "user_id", "total_purchases", "favorite_brand", "most_viewed_category", "last_seen_date"
    )
    return active.join(known, "user_id", "left").select(
        "user_id",
        segment(F.col("total_spend")).alias("segment"),
        "total_spend",
        "total_purchases",
        "days_active",
        "favorite_brand",
        "most_viewed_category",
        "last_seen_date",
    )


def segment_distribution(segments: DataFrame) -> DataFrame:
    """Users and average spend per segment, richest first."""
    return (
        segments.groupBy("segment")
        .agg(
            F.count("*").alias("user_count"),
            money_avg(F.col("total_spend")).alias("avg_spend"),
        )
        .orderBy(F.desc_nulls_last("avg_spend"), "segment")
    )


def segment_export(events: DataFrame, segments: DataFrame, as_of: str) -> DataFrame:
    """Segments with the time since the last purchase, as the serving store takes them."""
    bought = (
        events.where(is_type("purchase") & F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.max("event_time").alias("last_purchase_date"))
    )
    today = F.lit(as_of).cast("timestamp")
    return (
        segments.select("user_id", "segment", "total_purchases", "total_spend")
        .join(bought, "user_id", "left")
        .withColumn("days_since_last_purchase", day_diff(F.col("last_purchase_date"), today))
    )


def feature_columns(spend: Column | None = None) -> list[Column]:
    """Aggregates behind the user features, shared by the batch and the streaming refresh."""
    purchase = F.col("interaction_type") == "purchase"
    return [
        F.count_if(F.col("interaction_type") == "view").alias("total_views"),
        F.count_if(purchase).alias("total_purchases"),
        (F.count_if(purchase).cast("double") if spend is None else spend).alias("total_spend"),
        F.max("interaction_time").alias("last_activity_date"),
    ]


def user_behavior_features(interactions: DataFrame) -> DataFrame:
    """Features per user. Spend is real money where interactions carry a price, else a count."""
    spend = None
    if "price" in interactions.columns:
        bought = F.when(F.col("interaction_type") == "purchase", F.col("price"))
        spend = F.coalesce(money_sum(bought), F.lit(0.0))
    return interactions.groupBy("user_id").agg(*feature_columns(spend))


def with_favorites(features: DataFrame, profile: DataFrame) -> DataFrame:
    """Features with the favourite category and brand of the profile."""
    favorites = profile.select(
        "user_id",
        F.col("most_viewed_category").alias("favorite_category"),
        "favorite_brand",
    )
    return features.join(favorites, "user_id", "left")

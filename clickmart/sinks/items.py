"""Items for a key-value store: shaping as columns, writing from the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from clickmart.functions import default_text, safe_float, safe_int


def _stamp(as_of: Column | str | None) -> Column:
    moment = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")


def _text_time(c: str) -> Column:
    return default_text(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), "")


def segment_items(segments: DataFrame, as_of: str | None = None) -> DataFrame:
    """One item per user from the segment table."""
    return segments.select(
        default_text(F.col("user_id"), "unknown").alias("user_id"),
        default_text(F.col("segment"), "Unknown").alias("customer_segment"),
        safe_float(F.col("total_spend")).alias("total_spend"),
        safe_int(F.col("total_purchases")).alias("total_purchases"),
        default_text(F.col("favorite_brand"), "").alias("favorite_brand"),
        default_text(F.col("most_viewed_category"), "").alias("most_viewed_category"),
        _text_time("last_seen_date").alias("last_seen_date"),
        _stamp(as_of).alias("export_timestamp"),
    )


def recommendation_items(recommendations: DataFrame, as_of: str | None = None) -> DataFrame:
    """One item per user with the list of products as whole numbers.

    The list may also come as JSON text. An id that is not a number becomes 0, as the store has
    always received it; ``flat_items`` keeps text ids.
    """
    products = F.col("recommended_products")
    if dict(recommendations.dtypes)["recommended_products"] == "string":
        products = F.from_json(products, "array<string>")
    products = F.coalesce(products, F.array().cast("array<string>"))
    return recommendations.select(
        default_text(F.col("user_id"), "unknown").alias("user_id"),
        F.transform(products, safe_int).alias("recommended_products"),
        default_text(F.col("recommendation_reason"), "").alias("recommendation_reason"),
        _text_time("recommendation_date").alias("recommendation_date"),
        _stamp(as_of).alias("updated_at"),
    )


def flat_items(flat: DataFrame, as_of: str | None = None) -> DataFrame:
    """One item per user and product."""
    return flat.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("product_id").cast("string").alias("product_id"),
        F.coalesce(F.col("recommendation_score").cast("double"), F.lit(0.0)).alias(
            "recommendation_score"
        ),
        F.coalesce(F.col("rank").cast("long"), F.lit(0)).alias("rank"),
        _stamp(as_of).alias("updated_at"),
    )


def recency_items(segments: DataFrame, as_of: str | None = None) -> DataFrame:
    """One item per user from the segment export with purchase recency."""
    return segments.select(
        F.col("user_id").cast("string").alias("user_id"),
        "segment",
        F.coalesce(F.col("total_purchases").cast("long"), F.lit(0)).alias("total_purchases"),
        F.coalesce(F.col("total_spend").cast("double"), F.lit(0.0)).alias("total_spend"),
        _text_time("last_purchase_date").alias("last_purchase_date"),
        F.coalesce(F.col("days_since_last_purchase").cast("long"), F.lit(0)).alias(
            "days_since_last_purchase"
        ),
        _stamp(as_of).alias("updated_at"),
    )


def put_items(items: DataFrame, open_writer: Callable[[], AbstractContextManager[Any]]) -> None:
    """Put every item through a batch writer, one writer per partition.

    ``open_writer`` runs on the executors and returns a context manager with ``put_item``. Puts by
    key are idempotent, so a task that runs again after a lost executor does no harm.
    """

    def write(rows: Iterator[Row]) -> None:
        with open_writer() as writer:
            for row in rows:
                writer.put_item(row.asDict(recursive=True))

    items.foreachPartition(write)


def write_items_json(items: DataFrame, path: str) -> None:
    """The same items as JSON lines, the format bulk loaders of such stores take."""
    items.write.mode("overwrite").json(path)

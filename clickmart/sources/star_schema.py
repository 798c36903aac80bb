"""Star-schema tables (orders, line items, parts, user events) read as clickstream events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def clickstream(
    spark: SparkSession, directory: str, event_types: list[str] | None = None
) -> DataFrame:
    """All events with the attributes of their product, as a lake holds them.

    ``props.k`` names the product; a click puts it into the cart. Other event types pass as they are.
    ``event_types`` reads some types only, as ``read_lake`` does.
    """
    k = F.get_json_object("props", "$.k").cast("int")
    events = table(spark, directory, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", k.alias("k")
    )
    if event_types is not None:
        given = ["click" if name == "cart" else name for name in event_types]
        events = events.where(F.col("event_type").isin(sorted(given)))
    part = table(spark, directory, "part").select("p_partkey", "p_brand", "p_type")
    joined = events.join(part, F.col("p_partkey") == F.col("k"), "left")
    return joined.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("user_id").cast("string").alias("user_id"),
        F.when(F.col("event_type") == "click", "cart")
        .otherwise(F.col("event_type"))
        .alias("event_type"),
        F.concat(F.lit("prod_"), F.col("p_partkey").cast("string")).alias("product_id"),
        F.col("value").alias("price"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category_code"),
    )


def purchase_history(spark: SparkSession, directory: str) -> DataFrame:
    """Every line item as a purchase event: the larger input, whole orders sharing one time."""
    lines = table(spark, directory, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"
    )
    orders = table(spark, directory, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = table(spark, directory, "part").select("p_partkey", "p_brand", "p_type")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("event_id"),
            F.col("o_orderdate").cast("timestamp").alias("event_time"),
            F.col("o_custkey").cast("string").alias("user_id"),
            F.lit("purchase").alias("event_type"),
            F.concat(F.lit("prod_"), F.col("l_partkey").cast("string")).alias("product_id"),
            F.col("l_extendedprice").alias("price"),
            F.col("p_brand").alias("brand"),
            F.col("p_type").alias("category_code"),
        )
    )


def catalogue(spark: SparkSession, directory: str) -> DataFrame:
    """All parts as products. The rating is a stand-in by rule, since nothing given holds one."""
    return table(spark, directory, "part").select(
        F.concat(F.lit("prod_"), F.col("p_partkey").cast("string")).alias("product_id"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category_code"),
        F.col("p_retailprice").alias("price"),
        (1 + (F.col("p_size") % 9) * 0.5).alias("avg_rating"),
    )

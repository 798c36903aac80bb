"""Marts from what each day adds: parts are stored by day, and any span is rolled up without reading events.

A part holds what adds up, as counts and whole cents, and mergeable sketches of the users and products that were seen. A day is
stored as a partition, so computing it again replaces it. Distinct counts over a span are estimates, and
named so; everything else is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.functions import cents, guarded_ratio
from clickmart.plans.category_recs import ranked_products, sales
from clickmart.plans.marts import brand_columns, category_columns, funnel_sums, with_money

# Precision of the sketches: 2 ** 14 registers, a standard error of about 0.8 % in 16 KB at most.
LOG_REGISTERS = 14

DAY = "event_date"
_SUMS = "total_events long, purchase_count long, view_count long, cart_count long, _revenue long, _paid long, _priced long"
FUNNEL_SCHEMA = f"key string, {_SUMS}, users binary, products binary, {DAY} date"
SALES_SCHEMA = f"category_code string, product_id string, purchase_count long, paid long, priced long, {DAY} date"


def _day() -> Column:
    return F.to_date("event_time").alias(DAY)


def funnel_parts(events: DataFrame, key: str | None = None) -> DataFrame:
    """The part of every day and ``key``, a column that is not null; without it the part of every day."""
    known = events if key is None else events.where(F.col(key).isNotNull())
    name = (F.lit("all") if key is None else F.col(key)).alias("key")
    return known.groupBy(name, _day()).agg(
        *[c.alias(n) for n, c in funnel_sums().items()],
        F.hll_sketch_agg("user_id", LOG_REGISTERS).alias("users"),
        F.hll_sketch_agg("product_id", LOG_REGISTERS).alias("products"),
    ).select("key", *funnel_sums(), "users", "products", DAY)


def sales_parts(events: DataFrame) -> DataFrame:
    """Purchases of every day, category and product."""
    price = cents(F.col("price"))
    return sales(events).groupBy("category_code", "product_id", _day()).agg(
        F.count("*").alias("purchase_count"), F.sum(price).alias("paid"), F.count(price).alias("priced")
    ).select("category_code", "product_id", "purchase_count", "paid", "priced", DAY)


def replace_days(parts: DataFrame, root: str) -> None:
    """Store the days of ``parts``; a day that is there already is replaced, all others stay as they are.

    ``parts`` has to hold whole days. A job that dies while it puts its files in place is run again for the same days.
    Events without a time make a day of their own.
    """
    by_day = parts.repartition(DAY)
    by_day.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(root)


def _stored(spark: SparkSession, root: str, schema: str, since: str | None, until: str | None) -> DataFrame:
    """Parts of the days from ``since`` to before ``until``; whole partitions are left out. Without bounds every day."""
    rows = spark.read.schema(schema).parquet(root)
    if since is not None:
        rows = rows.where(F.col(DAY) >= F.lit(since).cast("date"))
    if until is not None:
        rows = rows.where(F.col(DAY) < F.lit(until).cast("date"))
    return rows


def _rolled(parts: DataFrame, keys: list[str], users: str, products: str) -> DataFrame:
    sums = [F.sum(n).alias(n) for n in funnel_sums()]
    estimate = lambda c: F.hll_sketch_estimate(F.hll_union_agg(c))
    return with_money(parts.groupBy(*keys).agg(*sums, estimate("users").alias(users), estimate("products").alias(products)))


def category_performance(spark: SparkSession, root: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """The category mart of a span, from stored parts by category; its distinct counts are estimates."""
    parts = _stored(spark, root, FUNNEL_SCHEMA, since, until).withColumnRenamed("key", "category_code")
    return category_columns(_rolled(parts, ["category_code"], "unique_users", "unique_products"))


def brand_performance(spark: SparkSession, root: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """The brand mart of a span, from stored parts by brand; its distinct counts are estimates."""
    parts = _stored(spark, root, FUNNEL_SCHEMA, since, until).withColumnRenamed("key", "brand")
    return brand_columns(_rolled(parts, ["brand"], "unique_customers", "unique_products"))


def daily_metrics(spark: SparkSession, root: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """The daily dashboard of a span, from stored parts by day; its users are estimates."""
    parts = _stored(spark, root, FUNNEL_SCHEMA, since, until).where(F.col(DAY).isNotNull())
    return _rolled(parts, [DAY], "total_users", "products").select(
        F.col(DAY).alias("metric_date"),
        "total_users",
        F.col("purchase_count").alias("total_purchases"),
        "total_revenue",
        F.col("avg_purchase_value").alias("avg_order_value"),
        guarded_ratio(F.col("purchase_count"), F.col("view_count")).alias("conversion_rate"),
        F.col("view_count").alias("total_views"),
        F.col("cart_count").alias("total_cart_additions"),
    )


def active_users(spark: SparkSession, root: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """One row with the users of a whole span, an estimate, and its events; days share users, so daily counts do not add up."""
    parts = _stored(spark, root, FUNNEL_SCHEMA, since, until)
    users = F.hll_sketch_estimate(F.hll_union_agg("users"))
    return parts.agg(F.coalesce(users, F.lit(0)).alias("users"), F.coalesce(F.sum("total_events"), F.lit(0)).alias("total_events"))


def category_top_products(
    spark: SparkSession,
    root: str,
    k: int = 5,
    tie_break: str | None = None,
    since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """The most bought products of each category over a span, ranked from stored sales alone. Exact."""
    counts = _stored(spark, root, SALES_SCHEMA, since, until).groupBy("category_code", "product_id").agg(
        F.sum("purchase_count").alias("purchase_count"),
        F.try_divide(F.sum("paid") / F.lit(100.0), F.sum("priced")).alias("avg_price"),
    )
    return ranked_products(counts, k, tie_break)

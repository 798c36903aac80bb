"""Declared schemas of the event stream, the lake and the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The fields of a wire event, all text.
WIRE_FIELDS = [
    "event_time",
    "event_type",
    "product_id",
    "category_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "user_session",
]

# Event types with a staging table of their own.
EVENT_TYPES = ["cart", "purchase", "view"]

WIRE_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in WIRE_FIELDS])

LAKE_SCHEMA = T.StructType(
    [
        T.StructField("event_time", T.TimestampType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("category_id", T.StringType()),
        T.StructField("category_code", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("user_session", T.StringType()),
        T.StructField("event_type", T.StringType()),
    ]
)

CANONICAL_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("brand", T.StringType()),
        T.StructField("category_code", T.StringType()),
    ]
)

PROFILE_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("favorite_brand", T.StringType()),
        T.StructField("most_viewed_category", T.StringType()),
        T.StructField("total_purchases", T.LongType()),
        T.StructField("total_spend", T.DoubleType()),
        T.StructField("last_seen_date", T.TimestampType()),
    ]
)

DAILY_METRICS_SCHEMA = T.StructType(
    [
        T.StructField("metric_date", T.DateType()),
        T.StructField("total_users", T.LongType()),
        T.StructField("total_purchases", T.LongType()),
        T.StructField("total_revenue", T.DoubleType()),
        T.StructField("avg_order_value", T.DoubleType()),
        T.StructField("conversion_rate", T.DoubleType()),
    ]
)

INTERACTION_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("interaction_type", T.StringType()),
        T.StructField("interaction_strength", T.IntegerType()),
        T.StructField("interaction_time", T.TimestampType()),
    ]
)

MODEL_SCHEMA = T.StructType(
    [
        T.StructField("model_id", T.IntegerType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("model_type", T.StringType()),
        T.StructField("algorithm", T.StringType()),
        T.StructField("parameters", T.StringType()),
        T.StructField("accuracy_score", T.DecimalType(5, 4)),
        T.StructField("is_active", T.BooleanType()),
    ]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast, order and complete the columns of ``df`` to ``schema``.

    Missing columns become typed NULLs. Text that does not parse becomes NULL instead of
    failing the job, which matters because ANSI mode makes a plain cast throw.
    """
    present = {name.lower() for name in df.columns}
    columns: list[Column] = []
    for field in schema.fields:
        source = F.col(field.name) if field.name.lower() in present else F.lit(None)
        columns.append(source.try_cast(field.dataType).alias(field.name))
    return df.select(*columns)


def to_canonical(df: DataFrame) -> DataFrame:
    """Typed projection onto the seven canonical event columns."""
    return conform(df, CANONICAL_SCHEMA)


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.upper() for name in df.columns])

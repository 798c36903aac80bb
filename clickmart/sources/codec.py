"""Events to JSON messages and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.schema import LAKE_SCHEMA, WIRE_FIELDS, WIRE_SCHEMA, conform


def blanks_to_null(df: DataFrame) -> DataFrame:
    return df.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in df.columns])


def encode_events(df: DataFrame) -> DataFrame:
    """One JSON message per event in ``value``, every field as text.

    Write the result with ``format("kafka")`` where a broker exists, or as text files.
    """
    wire = conform(df, WIRE_SCHEMA)
    return wire.select(F.to_json(F.struct(*WIRE_FIELDS)).alias("value"))


def decode_events(df: DataFrame, value_col: str = "value", keep_empty: bool = False) -> DataFrame:
    """Parse JSON messages into typed events.

    A message that is not valid JSON gives a row of NULLs, which ``valid_events`` then drops.
    Empty strings become NULL unless ``keep_empty`` is set. Works on batch and streaming frames.
    """
    parsed = F.from_json(F.col(value_col).cast("string"), WIRE_SCHEMA)
    fields = df.select(parsed.alias("data")).select("data.*")
    if not keep_empty:
        fields = blanks_to_null(fields)
    return conform(fields, LAKE_SCHEMA)


def valid_events(events: DataFrame) -> DataFrame:
    """The ingest rule: an event needs a user."""
    return events.where(F.col("user_id").isNotNull())


# Why a message is not taken.
NOT_JSON = "not valid JSON"
NO_USER = "no user"


def judge_messages(df: DataFrame, value_col: str = "value") -> DataFrame:
    """The fields of each message, the message itself in ``raw`` and, where it is not taken, the ``reason``.

    A message that is not one whole JSON object, a null or blank one included, is ``NOT_JSON``; one without a user is ``NO_USER``.
    Every message gives one row. Works on batch and streaming frames.
    """
    with_rest = T.StructType([*WIRE_SCHEMA.fields, T.StructField("_rest", T.StringType())])
    raw = F.col(value_col).cast("string")
    parsed = F.from_json(raw, with_rest, {"columnNameOfCorruptRecord": "_rest"})
    told = df.select(raw.alias("raw"), parsed.alias("data")).select("raw", "data.*", F.col("data").isNull().alias("_none"))
    told = told.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in WIRE_FIELDS})
    bad = F.col("_none") | F.col("_rest").isNotNull() | (F.trim(F.coalesce("raw", F.lit(""))) == "")
    reason = F.when(bad, NOT_JSON).when(F.col("user_id").isNull(), NO_USER)
    ends = [T.StructField("raw", T.StringType()), T.StructField("reason", T.StringType())]
    return conform(told.withColumn("reason", reason), T.StructType([*LAKE_SCHEMA.fields, *ends]))


def accepted_events(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("reason").isNull()).drop("raw", "reason")


def rejected_messages(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("reason").isNotNull()).select("raw", "reason")

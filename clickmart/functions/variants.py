"""JSON parameters as VARIANT: parsed once, read by path, written back as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_variant(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """``df`` with the JSON text of ``column`` as a VARIANT, in its place or as ``name``. Text that is no JSON becomes NULL."""
    return df.withColumn(name or column, F.try_parse_json(F.col(column)))


def parameter(variant: str, path: str, kind: str) -> Column:
    """The value at a path such as ``$.k``; NULL where there is none or it is not of the kind."""
    return F.try_variant_get(F.col(variant), path, kind)


def with_json(df: DataFrame, variant: str, name: str | None = None) -> DataFrame:
    """``df`` with the VARIANT as JSON text again, keys in the order of their names."""
    return df.withColumn(name or variant, F.to_json(F.col(variant)))

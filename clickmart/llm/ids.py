"""Whole numbers that stand for ids of any type, in the order of the ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.operators.ordered import number_rows


def whole(docs: DataFrame, column: str) -> bool:
    return isinstance(docs.schema[column].dataType, T.IntegralType)


def numbered(docs: DataFrame, column: str, number: str) -> tuple[DataFrame, DataFrame]:
    """``docs`` with ``number`` in place of an id that is no whole number, and (``number``, id): the places of the distinct ids in their order.

    A null id has no number.
    """
    ids = number_rows(docs.select(F.col(column).alias("_id")).where("_id IS NOT NULL").distinct(), [F.asc("_id")], number)
    found = docs.join(ids, docs[column] == ids["_id"], "left").drop("_id", column)
    return found, ids


def row_key(id_column: str, text_column: str) -> Column:
    """A 64-bit hash of id and text, null and empty told apart."""
    parts = [F.col(id_column).cast("string"), F.col(text_column).cast("string")]
    return F.xxhash64(*[x for p in parts for x in (p.isNull(), F.coalesce(p, F.lit("")))])

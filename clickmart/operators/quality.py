"""Checks of the constraints that the tables declare and Spark does not enforce."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Table name and number of rows."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df``, and what will be seen when it is written: ``row_count`` and, by column, the NULLs in ``nulls``.

    Counts while the rows go by, so nothing is read for them.
    """
    seen = Observation()
    nulls = [F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    return df.observe(seen, F.count(F.lit(1)).alias("row_count"), F.struct(*nulls).alias("nulls")), seen


def check_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Columns that are missing, unexpected or of another type. Empty when the schema fits."""
    actual = {f.name.lower(): f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name.lower(): f.dataType.simpleString() for f in expected.fields}
    rows = [
        (name, wanted.get(name), actual.get(name))
        for name in sorted(actual.keys() | wanted.keys())
        if wanted.get(name) != actual.get(name)
    ]
    schema = "column_name string, expected_type string, actual_type string"
    return df.sparkSession.createDataFrame(rows, schema)


def check_non_empty(tables: dict[str, DataFrame]) -> list[str]:
    """Names of the tables without any row. Looks for one row each, counts nothing."""
    return [name for name, df in tables.items() if df.isEmpty()]


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with the number of rows."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("row_count"))
    return counted.where(F.col("row_count") > 1)


def check_not_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Number of NULLs per column, all columns in one pass."""
    names = list(columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return counts.unpivot([], names, "column_name", "null_count")


def check_allowed(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows whose value is outside the allowed set. NULL passes, as in a CHECK constraint."""
    return df.where(~F.col(column).isin(values))


def check_reference(df: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows that point to a parent that does not exist. NULL passes, as in a foreign key."""
    parents = parent.select(F.col(key).alias(column)).distinct()
    return df.where(F.col(column).isNotNull()).join(parents, column, "left_anti")


def sample_rows(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first rows by key, the same ones on every run."""
    return df.orderBy(key).limit(n)


def partition_files(lake: DataFrame) -> DataFrame:
    """Files and rows per event type of the lake."""
    files = lake.groupBy("event_type", F.input_file_name().alias("file")).agg(
        F.count("*").alias("rows")
    )
    return files.groupBy("event_type").agg(
        F.count("*").alias("file_count"), F.sum("rows").alias("row_count")
    )

"""Reads, declarations and copies of catalog tables and external databases."""

from __future__ import annotations

from functools import reduce

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.schema import PROFILE_SCHEMA


def read_columns(spark: SparkSession, table: str, columns: Iterable[str]) -> DataFrame:
    """Named columns of a table, so the scan reads nothing else."""
    return spark.table(table).select(*columns)


def jdbc_read_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: str | int | None = None,
    upper: str | int | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if partition_column is not None:
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    columns: Iterable[str],
    properties: dict[str, str] | None = None,
    **partitioning,
) -> DataFrame:
    """Table of an external database, read by many tasks when a partition column is given."""
    options = jdbc_read_options(url, table, **partitioning) | (properties or {})
    return spark.read.format("jdbc").options(**options).load().select(*columns)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """Create an empty table if it does not exist yet and return it."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")
    return spark.table(name)


def copy_table(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Copy a table under another name, replacing what was there."""
    spark.table(source).write.mode("overwrite").format("parquet").saveAsTable(target)
    return spark.table(target)


def migrate_events(events: DataFrame) -> DataFrame:
    """Rows of a staging table that are worth moving: canonical columns, user present."""
    return events.select(
        "user_id", "event_time", "event_type", "product_id", "price", "brand", "category_code"
    ).where(F.col("user_id").isNotNull())


def migrate_profiles(profiles: DataFrame, text_id: str | None = None) -> DataFrame:
    """Profiles with a numeric user id. An id that is not a number becomes NULL.

    ``text_id`` names a further column for the id as it was, so that no profile loses its key.
    """
    rest = [F.col(name) for name in PROFILE_SCHEMA.names if name != "user_id"]
    if text_id is not None:
        rest.append(F.col("user_id").alias(text_id))
    return profiles.where(F.col("user_id").isNotNull()).select(
        F.col("user_id").try_cast(T.DecimalType(38, 0)).alias("user_id"), *rest
    )


def migrate_if_any(spark: SparkSession, moves: dict[str, str], append: bool = False) -> bool:
    """Move the sources to their targets, unless every source is empty.

    ``moves`` maps source to target table; a target may have several sources. Afterwards it holds their rows
    and no others, so a repeated run changes nothing. ``append`` keeps what a target holds and adds to it. Looking for
    one row is enough to decide.
    """
    if all(spark.table(source).isEmpty() for source in moves):
        return False
    for target in dict.fromkeys(moves.values()):
        parts = [migrate_events(spark.table(s)) for s, t in moves.items() if t == target]
        reduce(DataFrame.unionByName, parts).write.insertInto(target, overwrite=not append)
    return True


def describe_tables(spark: SparkSession, database: str = "default") -> DataFrame:
    """Tables and views of a database with their columns, one row per column."""
    schema = "table_name string, is_view boolean, column_name string, data_type string"
    rows = []
    for table in spark.catalog.listTables(database):
        name = table.name if table.isTemporary else f"{database}.{table.name}"
        for column in spark.catalog.listColumns(name):
            is_view = table.isTemporary or table.tableType == "VIEW"
            rows.append((table.name, is_view, column.name, column.dataType))
    return spark.createDataFrame(rows, schema)

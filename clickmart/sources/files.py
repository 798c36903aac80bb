"""Event dumps and the Parquet lake."""

from __future__ import annotations

import csv
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.schema import LAKE_SCHEMA, WIRE_SCHEMA, conform
from clickmart.sources.codec import blanks_to_null


def _headers(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files behind ``paths`` by their header row, which tasks find: the first line of the part that begins a file."""
    lines = spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("place"),
    )
    first = lines.where(F.col("at") == 0).groupBy("file").agg(F.min_by("value", "place").alias("line"))
    found: dict[tuple[str, ...], list[str]] = {}
    for row in first.orderBy("file").toLocalIterator():
        if row["line"]:
            header = next(csv.reader([row["line"].removeprefix("\ufeff")]))
            found.setdefault(tuple(c.strip() for c in header), []).append(unquote(row["file"]))
    return found


def read_events_csv(
    spark: SparkSession, path: str | list[str], keep_empty: bool = False, multi_line: bool = False
) -> DataFrame:
    """Event dumps with a header row, every value as text, columns matched by the header of their file.

    Files may have their columns in any order, lack some or have others besides. Quoted fields may span lines with
    ``multi_line``; a file is then read by one task. Without it one large file splits into many tasks.
    """
    frames = []
    for header, files in _headers(spark, [path] if isinstance(path, str) else path).items():
        names = [c if header.index(c) == i else f"{c}_{i}" for i, c in enumerate(header)]
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
        reader = spark.read.schema(schema).option("header", True).option("escape", '"')
        frames.append(conform(reader.option("multiLine", multi_line).csv(files), WIRE_SCHEMA))
    wire = reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], WIRE_SCHEMA)
    return wire.fillna("") if keep_empty else blanks_to_null(wire)


def _read_one(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(LAKE_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LAKE_SCHEMA)


def read_lake(
    spark: SparkSession, path: str | list[str], event_types: list[str] | None = None
) -> DataFrame:
    """Events of the lake, which is partitioned by event type; several lakes read as one.

    ``event_types`` prunes whole partitions. A lake nobody has written yet reads as an empty frame.
    """
    lakes = [_read_one(spark, p) for p in ([path] if isinstance(path, str) else path)]
    lake = reduce(DataFrame.unionByName, lakes)
    if event_types is not None:
        lake = lake.where(F.col("event_type").isin(event_types))
    return lake


def read_lake_glob(spark: SparkSession, path: str) -> DataFrame:
    """Every event-type folder through a wildcard, keeping the type as a column."""
    return (
        spark.read.schema(LAKE_SCHEMA)
        .option("basePath", path)
        .parquet(f"{path.rstrip('/')}/event_type=*/")
    )

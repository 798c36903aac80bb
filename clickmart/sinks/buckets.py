"""Tables whose rows lie in buckets by key, so that an upsert rewrites only the buckets that it touches.

The data of a write lie in a folder of their own, a folder a bucket. A small versioned list says which folder holds each bucket now, so
a write becomes visible as a whole, and readers keep the files that they have.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.operators.upsert import upsert
from clickmart.sinks.tables import latest_version, read_version, write_version

_PLACES = "bucket int, folder string, buckets int, keys string"


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _places(spark: SparkSession, root: str) -> tuple[DataFrame, int]:
    version = latest_version(spark, f"{root}/places")
    return (read_version(spark, f"{root}/places", version) if version else spark.createDataFrame([], _PLACES)), version


def _write(rows: DataFrame, root: str, keys: list[str], buckets: int) -> DataFrame:
    """Write rows by bucket; the buckets that got any, with their folder."""
    spark, folder = rows.sparkSession, f"{root}/data-{uuid.uuid4().hex}"
    spread = rows.withColumn("_bucket", _bucket(keys, buckets)).repartition("_bucket")
    spread.write.partitionBy("_bucket").parquet(folder)
    found = spark.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema.fields)}, _bucket int").parquet(folder)
    return found.select(F.col("_bucket").alias("bucket")).distinct().select(
        "bucket", F.lit(folder).alias("folder"), F.lit(buckets).alias("buckets"), F.lit(",".join(keys)).alias("keys")
    )


def write_buckets(rows: DataFrame, root: str, keys: list[str], buckets: int) -> int:
    """Write a table anew, with the number of its buckets; its version. Choose as many as a bucket fits a task."""
    return write_version(_write(rows, root, keys, buckets).coalesce(1), f"{root}/places")


def read_buckets(spark: SparkSession, root: str, schema, only: list[int] | None = None) -> DataFrame:
    """The table as it is now, or some of its buckets. ``schema`` is that of its rows."""
    places = _places(spark, root)[0]
    if only is not None:
        places = places.where(F.col("bucket").isin(only))
    paths = [f"{r['folder']}/_bucket={r['bucket']}" for r in places.collect()]  # one row a bucket
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def upsert_buckets(updates: DataFrame, root: str, schema, update_cols: list[str] | None = None) -> int:
    """Merge rows into the table as ``upsert`` does, and write only the buckets that hold one of their keys.

    Returns the new version. Two writers at the same time cannot both succeed: the later one fails and is to be run
    again. A key held twice fails the job before anything is visible.
    """
    spark = updates.sparkSession
    places, version = _places(spark, root)
    first = places.first()
    if first is None:
        raise ValueError(f"no buckets below {root}; write_buckets makes them")
    keys, buckets = first["keys"].split(","), first["buckets"]
    touched = [r[0] for r in updates.select(_bucket(keys, buckets)).distinct().collect()]  # no more than buckets
    merged = upsert(read_buckets(spark, root, schema, touched), updates, keys, update_cols)
    written = _write(merged, root, keys, buckets)
    now = places.where(~F.col("bucket").isin(touched)).unionByName(written)
    return write_version(now.coalesce(1), f"{root}/places", after=version)

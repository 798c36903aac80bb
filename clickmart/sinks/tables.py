"""Table sinks: catalog tables, versioned folders and external databases."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def overwrite_table(df: DataFrame, name: str) -> None:
    """Create or replace a table. The table must not be one ``df`` reads."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    """Plain insert; running it twice stores the rows twice."""
    df.write.mode("append").format("parquet").saveAsTable(name)


def insert_overwrite(df: DataFrame, name: str) -> None:
    """Replace the rows of an existing table, keeping its declaration; columns go by position."""
    df.write.insertInto(name, overwrite=True)


def replace_view(df: DataFrame, name: str) -> None:
    """View that lives as long as the session."""
    df.createOrReplaceTempView(name)


def replace_stored_view(spark: SparkSession, name: str, select: str) -> None:
    """View in the catalog, which outlives the session; ``select`` may read tables and stored views."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {select}")


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> None:
    """Table pre-hashed on ``key``, so that later joins and groupings on it need no exchange."""
    (
        df.write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(name)
    )


def _file_system(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def latest_version(spark: SparkSession, root: str) -> int:
    """Newest completely written version under ``root``, or 0 when there is none."""
    path, fs = _file_system(spark, root)
    if not fs.exists(path):
        return 0
    newest = 0
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith("version=") and fs.exists(done):
            newest = max(newest, int(name.removeprefix("version=")))
    return newest


def write_version(
    df: DataFrame, root: str, partition: str | None = None, after: int | None = None
) -> int:
    """Write ``df`` as the next version, or as the one ``after`` a given version and no other.

    ``df`` may read the current one: readers keep it until the new version is complete. It is written to a
    folder of its own and gets its number when it is done, by a rename that fails where that number is
    taken. So two writers never write into one folder, and a job that dies half-way leaves nothing that is read.
    """
    spark = df.sparkSession
    path, fs = _file_system(spark, root)
    hadoop = spark._jvm.org.apache.hadoop.fs
    written = hadoop.Path(path, f"_writing-{uuid.uuid4().hex}")
    writer = df.write if partition is None else df.write.partitionBy(partition)
    writer.parquet(written.toString())
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    never = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    version = (latest_version(spark, root) if after is None else after) + 1
    while True:
        target = hadoop.Path(path, f"version={version}")
        try:
            context.rename(fs.makeQualified(written), fs.makeQualified(target), never)
            return version
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
            if after is not None:
                raise ValueError(f"version {version} of {root} was written meanwhile") from error
            version += 1


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    version = version or latest_version(spark, root)
    return spark.read.parquet(f"{root}/version={version}")


def serving_options(url: str, table: str, batch: int = 1000) -> dict[str, str]:
    return {"url": url, "dbtable": table, "truncate": "true", "batchsize": str(batch)}


def write_serving_table(
    df: DataFrame,
    url: str,
    table: str,
    batch: int = 1000,
    connections: int = 16,
    properties: dict[str, str] | None = None,
) -> None:
    """Empty an external table and fill it in batches, straight from the executors.

    ``connections`` bounds the load on the database, whatever the number of partitions.
    """
    options = serving_options(url, table, batch) | {"numPartitions": str(connections)}
    df.write.format("jdbc").options(**options, **(properties or {})).mode("overwrite").save()


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)

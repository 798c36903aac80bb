"""User features kept up to date while interactions arrive.

Every micro-batch writes what it adds: counts, cents and the last activity of the users it has seen. Features are the
sums of all that, so they outlive a checkpoint, and no batch reads or keeps the history. Which batches of which
run a stored sum covers is written with it, in the same version.
"""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickmart.functions.expressions import cents
from clickmart.sinks.tables import latest_version, read_version, write_version

FEATURE_SCHEMA = "user_id string, total_views long, total_purchases long, total_spend double, last_activity_date timestamp"

# What is stored, by ``kind``: the sums of a user, a file that was counted, and the last batch of a run that sums cover.
USER, FILE, COVERED = "user", "file", "covered"
STORED_SCHEMA = (
    "kind string, user_id string, views long, purchases long, spend_cents long, last_activity_date timestamp, "
    "file string, run string, batch_id long"
)


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _deltas(spark: SparkSession, root: str, covered: dict[str, int]) -> dict[tuple[str, int], str]:
    """Folders of batches that are written to the end and that ``covered`` does not hold, by run and batch."""
    place, system = _hadoop(spark, root)
    found = {}
    for status in system.listStatus(place) if system.exists(place) else []:
        name = re.fullmatch(r"delta-([0-9a-f]+)-(\d+)", status.getPath().getName())
        if not name or int(name[2]) <= covered.get(name[1], -1):
            continue
        if system.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found[name[1], int(name[2])] = status.getPath().toString()
    return found


def _stored(spark: SparkSession, root: str) -> tuple[DataFrame, dict[str, int]]:
    """All rows that count, and the last batch of each run among them."""
    base, covered, frames = f"{root}/base", {}, [spark.createDataFrame([], STORED_SCHEMA)]
    version = latest_version(spark, base)
    if version:
        rows = read_version(spark, base, version)
        covered = {r["run"]: r["batch_id"] for r in rows.where(F.col("kind") == COVERED).select("run", "batch_id").collect()}
        frames.append(rows.where(F.col("kind") != COVERED))
    deltas = _deltas(spark, root, covered)
    if deltas:
        frames.append(spark.read.schema(STORED_SCHEMA).parquet(*deltas.values()))
    for run, batch in deltas:
        covered[run] = max(batch, covered.get(run, -1))
    stored = frames.pop(0)
    for frame in frames:
        stored = stored.unionByName(frame)
    return stored, covered


def _sums(stored: DataFrame) -> DataFrame:
    return stored.where(F.col("kind") == USER).groupBy("user_id").agg(
        F.sum("views").alias("views"),
        F.sum("purchases").alias("purchases"),
        F.sum("spend_cents").alias("spend_cents"),
        F.max("last_activity_date").alias("last_activity_date"),
    )


def _shaped(rows: DataFrame, kind: str) -> DataFrame:
    """``rows`` of one kind with all columns that are stored."""
    rows = rows.withColumn("kind", F.lit(kind))
    wanted = [part.split() for part in STORED_SCHEMA.split(", ")]
    return rows.select(*[(F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in wanted])


def _run_of(spark: SparkSession, root: str, checkpoint: str) -> str:
    """The run that a checkpoint stands for. A new one first notes the files that all runs before it have counted."""
    folder, system = _hadoop(spark, f"{checkpoint}/feature-run")
    if system.exists(folder) and (names := system.listStatus(folder)):
        return names[0].getPath().getName()
    run = uuid.uuid4().hex
    files = _stored(spark, root)[0].where(F.col("kind") == FILE).select("file").distinct()
    files.write.parquet(f"{root}/before-{run}")
    system.mkdirs(spark._jvm.org.apache.hadoop.fs.Path(folder, run))
    return run


def start_feature_refresh(
    interactions: DataFrame, root: str, checkpoint: str, trigger: str | None = "1 minute"
) -> StreamingQuery:
    """Add the interactions of each micro-batch to the features below ``root``.

    A batch that is run again replaces what it wrote, so nothing is counted twice. A new checkpoint begins a new run,
    which adds to what all runs before it have counted. Where messages are read from files, files that those
    runs have counted are left out; from other sources a new run has to begin at messages that none of them has seen. Runs at
    the same time need messages of their own. Spend is exact money where interactions carry a price, else a count.
    """
    spark = interactions.sparkSession
    run = _run_of(spark, root, checkpoint)
    before = spark.read.schema("file string").parquet(f"{root}/before-{run}")
    known = not before.isEmpty()
    try:
        stream, from_files = interactions.withColumn("_file", F.col("_metadata.file_path")), True
    except AnalysisException:  # the source has no files
        stream, from_files = interactions, False
    bought = F.col("interaction_type") == "purchase"
    price = cents(F.col("price")) if "price" in interactions.columns else F.lit(100).cast("long")
    added = [
        F.count_if(F.col("interaction_type") == "view").alias("views"),
        F.count_if(bought).alias("purchases"),
        F.coalesce(F.sum(F.when(bought, price)), F.lit(0)).alias("spend_cents"),
        F.max("interaction_time").alias("last_activity_date"),
    ]

    def write(batch: DataFrame, batch_id: int) -> None:
        fresh = batch.join(before.withColumnRenamed("file", "_file"), "_file", "left_anti") if known and from_files else batch
        rows = _shaped(fresh.groupBy("user_id").agg(*added), USER)
        if from_files:
            rows = rows.unionByName(_shaped(batch.select(F.col("_file").alias("file")).distinct(), FILE))
        rows.write.mode("overwrite").parquet(f"{root}/delta-{run}-{batch_id}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
    return writer.start()


def read_features(spark: SparkSession, root: str) -> DataFrame:
    """Current features, one row per user. Empty before the first batch.

    Adds what was compacted last and the complete batches that it does not cover.
    """
    return _sums(_stored(spark, root)[0]).select(
        "user_id",
        F.col("views").alias("total_views"),
        F.col("purchases").alias("total_purchases"),
        (F.col("spend_cents") / F.lit(100.0)).alias("total_spend"),
        "last_activity_date",
    )


def compact_features(spark: SparkSession, root: str, target: str) -> int:
    """Write the current features as the next version of a table that the recommenders read.

    The sums also become the base of later reads, so these do not grow with the number of batches. Compactions at
    the same time do no harm: each version names the batches that it covers.
    """
    stored, covered = _stored(spark, root)
    files = stored.where(F.col("kind") == FILE).select("file").distinct()
    runs = spark.createDataFrame(list(covered.items()), "run string, batch_id long")
    rows = _shaped(_sums(stored), USER).unionByName(_shaped(files, FILE)).unionByName(_shaped(runs, COVERED))
    write_version(rows, f"{root}/base")
    return write_version(read_features(spark, root), target)

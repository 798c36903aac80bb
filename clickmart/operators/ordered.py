"""Places and next values along an order, without putting all rows or a heavy key into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.operators.materialize import materialize

# Rows of a range: what a task sorts at a time, whatever the input.
ROWS_OF_RANGE = 100_000


def range_count(df: DataFrame) -> int:
    """As many ranges as there are shuffle partitions, or more, so that one has about ``ROWS_OF_RANGE`` rows. Counts ``df``."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS_OF_RANGE))


def lead_by_key(
    df: DataFrame,
    key: str,
    order: list[str],
    value: str,
    alias: str,
    ranges: int | None = None,
    keep_range: bool = False,
) -> DataFrame:
    """``df`` with the ``value`` of the next row of the same ``key`` along ``order``.

    All rows are sorted by key and order into ranges, as many as there are shuffle partitions, or more so that
    a range has about ``ROWS_OF_RANGE`` rows, unless ``ranges`` says otherwise; a key of any size spreads over as many of them as it needs. Within a
    range the next row stands beside; the last row of a key in a range takes the first value of the key's next range.
    ``key`` must not be NULL. With ``keep_range`` the number of the range stays as ``_range``; the result is partitioned
    by it, so groups within a range need no exchange.
    """
    columns = [*df.columns, "_range"] if keep_range else df.columns
    if ranges is None:
        df = materialize(df)
        ranges = range_count(df)
    # Written out because the range number is a property of the task that produced the row: two
    # readers must see the same one.
    cut = materialize(
        df.repartitionByRange(ranges, key, *order).withColumn("_range", F.spark_partition_id())
    )
    cut = cut.repartition(ranges, "_range")
    inside = Window.partitionBy(key, "_range").orderBy(*order)
    ahead = Window.partitionBy(key).orderBy("_range")
    heads = cut.groupBy(key, "_range").agg(
        F.min(F.struct(*order, F.col(value).alias("_value"))).alias("_head")
    )
    # Only keys that go on in a further range have something to hand over: fewer rows than ranges.
    follow = heads.select(key, "_range", F.lead("_head").over(ahead).alias("_next")).where(
        "_next IS NOT NULL"
    )
    follow = follow.select(key, "_range", F.col("_next._value").alias("_next_head"))
    return (
        cut.withColumn("_inside", F.lead(value).over(inside))
        .withColumn("_is_last", F.lead(F.lit(True)).over(inside).isNull())
        .join(F.broadcast(follow), [key, "_range"], "left")
        .withColumn(alias, F.when(F.col("_is_last"), F.col("_next_head")).otherwise(F.col("_inside")))
        .select(*columns, alias)
    )


def number_rows(df: DataFrame, order: list[Column], alias: str) -> DataFrame:
    """``df`` with the place of each row along ``order``: 1, 2, 3, and so on over all rows.

    Rows are sorted into ranges and numbered there; what lies before a range is added. Written out, so
    that every reader sees the same places.
    """
    spread = F.monotonically_increasing_id()  # the task in the upper bits, the row within it in the lower
    cut = materialize(
        df.orderBy(*order).select(
            "*",
            F.shiftright(spread, 33).alias("_part"),
            spread.bitwiseAND(F.lit((1 << 33) - 1)).alias("_within"),
        )
    )
    sizes = cut.groupBy("_part").count()  # one row for each partition
    before = F.sum("count").over(Window.orderBy("_part")) - F.col("count")
    sizes = F.broadcast(sizes.select("_part", before.alias("_before")))
    place = F.col("_before") + F.col("_within") + 1
    return cut.join(sizes, "_part").select(*df.columns, place.alias(alias))

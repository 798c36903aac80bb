"""Shards of near equal size, by sampled splitters.

Records are ordered by a key. A sample in which each record stands by its size gives quantiles of the keys, the
splitters, which part all records into ranges; a range that holds more than its share is parted again by a
sample of its own records, down to single rows of a key, so that a key of any weight spreads over tasks. Within a range
records are sorted and summed, sums of whole ranges are added, and each record so learns its place and the bytes
before it in the order of all records. Shards are cut from that order at equal sizes. The splitters decide
which task does what; the shards are those of the whole order, so they do not depend on the sample.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.operators.materialize import materialize

RANGES = 1024
SAMPLED = 32  # records drawn for a range
OVERFULL = 2  # times the mean size of a range
SLACK = 0.05  # of a shard: groups up to this size stay whole
SEED = 20240711
PLACE = "struct<key:string,within:string,tie:bigint>"


def fixed(values: list, kind: str) -> Column:
    """A small list as a constant."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


def rank_among(bounds: list, kind: str, me: Column) -> Column:
    """How many of the sorted bounds are not above ``me``: a binary search in a constant."""
    if not bounds:
        return F.lit(0)
    values = fixed(bounds, kind)
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    return F.aggregate(
        fixed(steps, "int"),
        F.lit(0),
        lambda at, step: F.when((at + step <= len(bounds)) & (F.get(values, at + step - 1) <= me), at + step).otherwise(at),
    )


def range_of(splitters: list[dict]) -> Column:
    return rank_among(splitters, PLACE, F.struct("key", "within", "tie"))


def drawn(records: DataFrame, rate: Column | float) -> DataFrame:
    """Records drawn with a chance of size x rate, at most 1."""
    chance = F.pmod(F.xxhash64("tie", F.lit(SEED)), F.lit(1 << 40)) / (1 << 40)
    return records.where(chance < F.col("size") * rate)


def first_splitters(records: DataFrame, total: int, ranges: int) -> list[dict]:
    """Keys at the quantiles of a size-weighted sample; a key stands for its first row."""
    sample = drawn(records, SAMPLED * ranges / total).select("key", F.ntile(ranges).over(Window.orderBy("key")).alias("tile"))
    keys = {r["key"] for r in sample.groupBy("tile").agg(F.min("key").alias("key")).where("tile > 1").collect()}
    return [{"key": key, "within": "", "tie": -1} for key in sorted(keys, key=lambda k: k.encode())]


def sizes(records: DataFrame, splitters: list[dict]) -> list[tuple[int, int]]:
    """(bytes, rows) of each range."""
    found = records.groupBy(range_of(splitters).alias("range")).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    by_range = {r["range"]: (r["size"], r["n"]) for r in found.collect()}
    return [by_range.get(i, (0, 0)) for i in range(len(splitters) + 1)]


def more_splitters(records: DataFrame, splitters: list[dict], counted: list[tuple[int, int]], share: float) -> list[dict]:
    """Splitters within the ranges that hold more than OVERFULL times ``share``, at quantiles of their own samples."""
    pieces = [-int(-size // share) if size > OVERFULL * share and n > 1 else 0 for size, n in counted]
    if not any(pieces):
        return []
    weight = sum(size for (size, _), k in zip(counted, pieces, strict=True) if k)
    placed = records.withColumn("range", range_of(splitters)).withColumn("pieces", F.get(fixed(pieces, "int"), F.col("range")))
    sample = drawn(placed.where("pieces > 0"), SAMPLED * sum(pieces) / weight)
    own = Window.partitionBy("range")
    place = F.row_number().over(own.orderBy("key", "within", "tie")) - 1
    tile = F.floor(place * F.col("pieces") / F.count("*").over(own))
    cut = sample.withColumn("tile", tile).groupBy("range", "tile").agg(F.min(F.struct("key", "within", "tie")).alias("place"))
    known = {(s["key"], s["within"], s["tie"]) for s in splitters}
    return [r["place"].asDict() for r in cut.where("tile > 0").collect() if tuple(r["place"]) not in known]


def shard(
    records: DataFrame,
    shards: int,
    key: Column,
    size: Column,
    within: Column | None = None,
    ranges: int = RANGES,
    slack: float = SLACK,
) -> DataFrame:
    """``records`` with ``shard`` (0 to shards - 1) and ``slot`` (from 0 without gaps in each shard).

    Shards follow the order of ``key``, then ``within``, both as text by code point, and have near equal sums of
    ``size``: each differs from the mean by no more than its largest record or ``slack`` of the mean. Records of the same
    key stay together if all of them are at most ``slack`` of a shard; larger groups are cut where the shard is full.
    Rows that agree in key and within may stand in any order, so reruns agree but for such rows.

    A null key or within is an empty text, a null or negative size is 0; if all sizes are 0 everything is shard 0. Repeated
    rows are placed one by one. Columns named shard and slot are replaced, others of any name are kept. An empty
    table gives an empty result. Driver and broadcasts hold splitters and range sums, some thousands whatever the input;
    the first row of each shard is joined as one row a shard. All rows are written twice below spark.checkpoint.dir.
    """
    kept = [c for c in records.columns if c not in ("shard", "slot")]
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    records = materialize(
        records.select(
            F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
            text(key).alias("key"),
            text(F.lit("") if within is None else within).alias("within"),
            F.monotonically_increasing_id().alias("tie"),
            F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0)).alias("size"),
        )
    )
    total = records.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    splitters = first_splitters(records, total, ranges) if total else []
    counted = sizes(records, splitters)
    while total and (new := more_splitters(records, splitters, counted, total / ranges)):
        splitters = sorted(splitters + new, key=lambda s: (s["key"].encode(), s["within"].encode(), s["tie"]))
        counted = sizes(records, splitters)

    before, bytes_before, rows_before = (0, 0), [], []
    for held in counted:
        bytes_before.append(before[0])
        rows_before.append(before[1])
        before = (before[0] + held[0], before[1] + held[1])
    inside = Window.partitionBy("range").orderBy("key", "within", "tie")
    group = Window.partitionBy("range", "key")
    earlier = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = materialize(
        records.withColumn("range", range_of(splitters))
        .withColumn("before", earlier + F.get(fixed(bytes_before, "bigint"), F.col("range")))
        .withColumn("place", F.row_number().over(inside) + F.get(fixed(rows_before, "bigint"), F.col("range")))
        .withColumn("group_start", F.min("before").over(group))
        .withColumn("group_size", F.sum("size").over(group))
        .select("row", "key", "size", "before", "place", "group_start", "group_size")
    )
    # Groups that a splitter cuts, no more than there are splitters, are summed over their ranges.
    cut = fixed(sorted({s["key"] for s in splitters if s["tie"] >= 0}), "string")
    whole = placed.where(F.array_contains(cut, F.col("key"))).groupBy("key")
    whole = whole.agg(F.min("group_start").alias("whole_start"), F.sum("size").alias("whole_size"))
    placed = placed.join(F.broadcast(whole), "key", "left")
    start, held = F.coalesce("whole_start", "group_start"), F.coalesce("whole_size", "group_size")
    together = held <= slack * total / shards
    middle = F.when(together, start + held / 2).otherwise(F.col("before") + F.col("size") / 2)
    number = F.least(F.floor(middle * shards / max(total, 1)), F.lit(shards - 1)).cast("int")
    numbered = placed.select("row", "place", number.alias("shard"))
    first = numbered.groupBy("shard").agg(F.min("place").alias("first"))
    return numbered.join(F.broadcast(first), "shard").select(
        "row.*", "shard", (F.col("place") - F.col("first")).alias("slot")
    )


def write_shards(sharded: DataFrame, folder: str) -> None:
    """One folder ``shard=N`` for each shard, its records in the order of their slots.

    A shard is written by one task, so it should have the size of a file; it is sorted with spilling.
    """
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)

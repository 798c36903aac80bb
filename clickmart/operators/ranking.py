"""Best value and top rows per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str) -> DataFrame:
    """The first ``n`` rows per key along ``order``, numbered from 1 in ``rank``.

    Filtering on the number lets Catalyst cut every group to ``n`` rows before the exchange, so a
    heavy key does not reach a single task as a whole.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


# Groups merged into one on each level of ``top_n_tree``.
FAN_IN = 64


def top_n_tree(
    df: DataFrame, key: str, spread: str, parts: Column, order: list[Column], n: int, rank: str
) -> DataFrame:
    """``top_n`` of one key for large ``n`` and groups of any size.

    Beyond some ``n`` Catalyst no longer cuts groups early. Here each group is ranked in ``parts``
    parts, by hash of ``spread``, and the winners are merged level by level, so that no task ever
    ranks more than one part or ``FAN_IN * n`` rows.
    """
    df = df.withColumn("_part", F.pmod(F.xxhash64(spread), F.greatest(parts, F.lit(1))))
    for part in (F.col("_part"), F.col("_part") % FAN_IN):
        df = top_n(df.withColumn("_part", part), [key, "_part"], order, n, "_place").drop("_place")
    return top_n(df.drop("_part"), [key], order, n, rank)


def best_value(value: Column, weight: Column, where: Column) -> Column:
    """Aggregate: the value with the highest weight, the smallest one among equals.

    Pre-aggregates like any minimum, where a window would sort the group.
    """
    candidate = F.struct((-weight).alias("w"), value.alias("v"))
    return F.min(F.when(where & value.isNotNull(), candidate))["v"]


def collect_ranked(rank: str, value: str) -> Column:
    """Aggregate: values as an array in rank order. For groups already cut to a few rows."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(rank), F.col(value))))
    return F.transform(ordered, lambda item: item[value])

"""Upserts as joins, for tables whose format has no MERGE."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(
    target: DataFrame, updates: DataFrame, keys: list[str], update_cols: list[str] | None = None
) -> DataFrame:
    """Target with the updates merged in. A key that either side holds twice fails the job.

    Without ``update_cols`` a matching row is replaced. With it only those columns take the new
    value, a NULL included, and every other column of a matching row keeps the old one. Keys that
    are new are inserted either way, and NULL is a key like any other. On a catalog with MERGE, use
    ``DataFrame.mergeInto``.
    """
    updates = _complete(updates, target)
    if update_cols is None:
        update_cols = [c for c in target.columns if c not in keys]

    # Putting both under each other and grouping by key pairs them up like a full outer join would,
    # whatever the keys look like.
    row = F.struct(*target.columns)
    none = F.lit(None).cast(target.select(row.alias("row")).schema["row"].dataType)
    sides = target.select(*keys, row.alias("_old"), none.alias("_new")).unionByName(
        updates.select(*keys, none.alias("_old"), row.alias("_new"))
    )
    both = (
        sides.groupBy(*keys)
        .agg(
            F.first("_old", ignorenulls=True).alias("_old"),
            F.first("_new", ignorenulls=True).alias("_new"),
            F.greatest(F.count("_old"), F.count("_new")).alias("_times"),
        )
        .where(F.assert_true(F.col("_times") < 2, F.lit("a key is held twice")).isNull())
    )
    columns = []
    for name in target.columns:
        if name in keys:
            columns.append(F.col(name))
            continue
        first, second = ("_new", "_old") if name in update_cols else ("_old", "_new")
        columns.append(
            F.when(F.col(first).isNotNull(), F.col(f"{first}.{name}"))
            .otherwise(F.col(f"{second}.{name}"))
            .alias(name)
        )
    return both.select(*columns)


def insert_ignore(
    target: DataFrame, rows: DataFrame, keys: list[str], order: list[str] | None = None
) -> DataFrame:
    """Target plus the rows whose key it does not hold yet; NULL is a key like any other.

    Of several new rows with one key the first along ``order`` stays, and without it, or on ties, the
    smallest by all columns.
    """
    rows = _complete(rows, target)
    ranked = F.struct(*(order or []), F.struct(*target.columns).alias("_row"))
    fresh = rows.groupBy(*keys).agg(F.min(ranked).alias("_first")).select("_first._row.*")
    known = target.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in keys]
    return target.unionByName(fresh.join(known, same, "left_anti").select(*target.columns))


def _complete(rows: DataFrame, target: DataFrame) -> DataFrame:
    types = dict(target.dtypes)
    present = set(rows.columns)
    return rows.select(
        *[
            (F.col(c) if c in present else F.lit(None)).cast(types[c]).alias(c)
            for c in target.columns
        ]
    )

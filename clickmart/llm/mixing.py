"""Mixing sources to target weights by capped water-filling, with DataFrame functions only.

Each source gets words in proportion to its weight, but no more than ``max_epochs`` times what it has. What a
clamped source cannot take is dealt to the others by weight, round by round, until nobody is above its cap.
A source then repeats all its documents as often as fits, and fills up with documents in a seeded order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.operators.materialize import materialize

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of runs without white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place``: 0, 1, .. by code point, null last, without one task for all sources."""
    spread = F.monotonically_increasing_id()
    ordered = materialize(
        sources.orderBy(F.asc_nulls_last("source")).select(
            "*", F.shiftright(spread, 33).alias("part"), spread.bitwiseAND(F.lit((1 << 33) - 1)).alias("within")
        )
    )
    parts = ordered.groupBy("part").count()  # one row for each partition
    before = F.sum("count").over(Window.orderBy("part")) - F.col("count")
    parts = parts.select("part", before.alias("before"))
    return ordered.join(parts, "part").withColumn("place", F.col("before") + F.col("within")).drop("part", "within", "before")


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, max_epochs: float) -> DataFrame:
    """(source, place, source_size, target) from (source, source_size).

    ``weights`` repeat along the sources by code point, null last. The targets add up to ``share`` times all sizes,
    or to all caps if that is less. Each round raises the level for those below their cap and ends when no further
    source is clamped; a round is one small aggregate over the table of sources.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    table = numbered(sources).withColumn("weight", weight)
    table = materialize(table.withColumn("cap", F.col("source_size") * F.lit(float(max_epochs))))
    first = table.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    budget = share * (first["size"] or 0)
    left, weight_left, clamped = budget, first["weight"] or 1.0, 0
    while True:
        above = F.col("weight") * F.lit(left) > F.col("cap") * F.lit(weight_left)
        if weight_left == 0:
            above = F.lit(True)
        row = table.agg(
            F.count_if(above).alias("clamped"),
            F.sum(F.when(above, F.col("cap")).otherwise(0.0)).alias("cap"),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if row["clamped"] <= clamped:
            break
        clamped, left, weight_left = row["clamped"], budget - row["cap"], row["weight"]
    level = F.lit(None).cast("double") if weight_left == 0 else F.col("weight") * F.lit(left) / F.lit(weight_left)
    return table.select(
        "source", "place", "source_size", F.when(above, F.col("cap")).otherwise(level).alias("target")
    )


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: str = "mix",
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """What the mix takes of each document: (doc_id, source, size, source_size, target, taken), a row per row.

    Sizes are words. ``taken`` is the number of words, repeats counted: every document of a source as many whole
    times as its target allows, and once more along the order of md5(seed, id) until the target is reached;
    the document at which that happens gives its leading words only. So a source takes its target to the word.
    A null source is a source of its own, placed last; null texts have size 0 and are taken 0 times; a document with a null
    id is placed in the order by its text, so many of them spread over the buckets. Repeated rows are documents of their own. Other columns are not read. An empty table gives an empty result.
    """
    key = F.coalesce(F.col(id_column).cast("string"), F.md5(F.col(text_column).cast("string")), F.lit(""))
    order = F.md5(F.concat_ws(":", F.lit(seed), key))
    sized = materialize(
        docs.select(
            F.col(id_column).alias("doc_id"),
            F.col(source_column).cast("string").alias("source"),
            word_count(F.col(text_column).cast("string")).alias("size"),
            order.alias("order"),
        )
    )
    sources = materialize(
        targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, max_epochs)
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sources = sources.withColumn("whole", whole.cast("long")).withColumn(
        "rest", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long")
    )
    placed = sized.join(
        sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))
    ).drop("_source")
    # Words before a document in its source: those of earlier buckets of the order, and of its own bucket.
    placed = placed.withColumn("bucket", F.substring("order", 1, 3))
    buckets = placed.groupBy("place", "bucket").agg(F.sum("size").alias("held"))
    ahead = F.sum("held").over(Window.partitionBy("place").orderBy("bucket")) - F.col("held")
    buckets = buckets.select("place", "bucket", ahead.alias("ahead"))  # at most 4096 rows a source
    along = Window.partitionBy("place", "bucket").orderBy("order", "doc_id", "size")
    along = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.col("ahead") + F.sum("size").over(along) - F.col("size")
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("rest") - before))
    return placed.join(buckets, ["place", "bucket"]).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("whole") * F.col("size") + part).alias("taken"),
    )


def repeat_texts(docs: DataFrame, plan: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The mixed corpus: a row of ``docs`` for every repetition, the last one cut to the words that are taken.

    Ids have to be unique and not null here. Rows that are not taken are left out.
    """
    size, taken, copy = F.col("_mix_size"), F.col("_mix_taken"), F.col("_mix_copy")
    plan = plan.where("taken > 0").select(
        F.col("doc_id").alias("_mix_id"), F.col("size").alias("_mix_size"), F.col("taken").alias("_mix_taken")
    )
    times = F.ceil(taken / size).cast("int")
    words = F.least(size, taken - copy * size)
    joined = docs.join(plan, docs[id_column] == F.col("_mix_id")).withColumn(
        "_mix_copy", F.explode(F.sequence(F.lit(0), times - 1))
    )
    parts = F.regexp_extract_all(F.col(text_column), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    lead = F.array_join(F.slice(parts, F.lit(1), words.cast("int")), "")
    cut = F.when(words < size, lead).otherwise(F.col(text_column))
    return joined.withColumn(text_column, cut).drop("_mix_id", "_mix_copy", "_mix_size", "_mix_taken")

"""Cosine similarity of users by the products they interacted with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.functions import strength
from clickmart.operators.blocks import (
    FOUND,
    LANE_ENTRIES,
    LANE_WORK,
    WIDE_ROWS,
    best_partners,
    lane_count,
    meet,
    meet_in_lanes,
    pack,
    partners_in_lane,
)
from clickmart.operators.materialize import materialize
from clickmart.operators.ordered import number_rows
from clickmart.operators.ranking import top_n

# Users of a product whose list is not long: its users are added up entry by entry, longer lists as matrices. Also users
# on the left of a product that one task joins.
BLOCK_USERS = 1000
# No list is long that has not so many users for each place in the result.
SEEDS = 4


def interactions_from_events(events: DataFrame) -> DataFrame:
    """Interactions with their strength, one per user, product, type and time.

    Events are exchanged once, by user: what is added up by user, or by user and product, needs no further exchange.
    The strength follows from the type and is not exchanged.
    """
    kind = F.col("interaction_type")
    return (
        events.where(F.col("user_id").isNotNull() & F.col("product_id").isNotNull())
        .where(strength(F.col("event_type")).isNotNull())
        .select(
            "user_id",
            "product_id",
            F.col("event_type").alias("interaction_type"),
            F.col("event_time").alias("interaction_time"),
        )
        .repartition("user_id")
        .dropDuplicates(["user_id", "product_id", "interaction_type", "interaction_time"])
        .select("user_id", "product_id", kind, strength(kind).alias("interaction_strength"), "interaction_time")
    )


def user_vectors(interactions: DataFrame) -> DataFrame:
    """Summed strength, sum of squared strengths and number of interactions per user and product."""
    value = F.col("interaction_strength").cast("long")
    return interactions.groupBy("user_id", "product_id").agg(
        F.sum(value).alias("weight"), F.sum(value * value).alias("squares"), F.count("*").alias("interactions")
    )


def write_vectors(interactions: DataFrame) -> DataFrame:
    """``user_vectors``, written with the entries of a user beside each other, so that they pack well and are exchanged as few rows."""
    return materialize(user_vectors(interactions).sortWithinPartitions("user_id", "product_id"))


def user_norms(vectors: DataFrame, mode: str) -> DataFrame:
    """Squared norm per user.

    ``vector`` takes the norm of the summed strengths, which makes the similarity a true cosine.
    ``rows`` takes the norm over single interactions while products still match row by row, so a
    user with several interactions per product can reach a similarity above 1.
    """
    return vectors.groupBy("user_id").agg(F.sum(_square(mode)).alias("norm"))


def _square(mode: str) -> Column:
    if mode not in ("vector", "rows"):
        raise ValueError(f"unknown similarity mode: {mode}")
    return F.col("weight") * F.col("weight") if mode == "vector" else F.col("squares")


def _cosine(dot: Column, norm_1: Column, norm_2: Column) -> Column:
    return F.round(dot / F.sqrt(norm_1.cast("double") * norm_2.cast("double")), 4)


def user_similarity(
    interactions: DataFrame, pairs: DataFrame, mode: str = "vector"
) -> DataFrame:
    """Similarity of the given pairs (``user_1``, ``user_2``); 0 where nothing is shared.

    Looks up the two vectors of each pair, so the work grows with the pairs and never with the
    square of a product's users.
    """
    vectors = user_vectors(interactions)
    norms = user_norms(vectors, mode)
    wanted = pairs.select("user_1", "user_2").distinct()
    first = vectors.select(F.col("user_id").alias("user_1"), "product_id", "weight")
    second = vectors.select(
        F.col("user_id").alias("user_2"), "product_id", F.col("weight").alias("weight_2")
    )
    dots = (
        wanted.join(first, "user_1")
        .join(second, ["user_2", "product_id"])
        .groupBy("user_1", "user_2")
        .agg(F.sum(F.col("weight") * F.col("weight_2")).alias("dot"))
    )
    for side in ("1", "2"):
        norm = norms.select(F.col("user_id").alias(f"user_{side}"), F.col("norm").alias(f"n{side}"))
        dots = dots.join(norm, f"user_{side}")
    scored = dots.select(
        "user_1", "user_2", _cosine(F.col("dot"), F.col("n1"), F.col("n2")).alias("score")
    )
    return wanted.join(scored, ["user_1", "user_2"], "left").select(
        "user_1", "user_2", F.coalesce("score", F.lit(0.0)).alias("similarity_score")
    )


def similar_users(
    interactions: DataFrame | None,
    k: int = 10,
    mode: str = "vector",
    targets: DataFrame | None = None,
    block: int = BLOCK_USERS,
    vectors: DataFrame | None = None,
) -> DataFrame:
    """The ``k`` most similar other users per user, exact.

    Without ``targets`` (a frame with ``user_id``) every user gets a list. Equally similar users
    are ordered by id. When fewer than ``k`` users share anything, the lowest ids fill up with
    similarity 0.

    Users with the very same vector are compared once, as one: a group of copies, however large,
    costs no more than a single user.

    Users are packed into blocks, and each block meets all others inside tasks (``operators/blocks.py``): pairs are never rows
    that Spark exchanges or writes, only the best ``k`` of each user are. Where all products have up to ``block`` users they are added up entry by
    entry, in lanes. Longer lists are added up as matrices, strongest users first, and only for users whom somebody in a
    block could still give a better score than the one they have. A few ``targets`` are joined with their lists instead, if that makes no more
    rows than it reads. Who has the ``vectors`` (of ``write_vectors``) passes them, and ``interactions`` are not read.
    """
    raw = write_vectors(interactions) if vectors is None else vectors
    members = _members(raw, mode)
    alike = members.where("uid = alike")
    vectors = materialize(raw.join(alike, "user_id").select("uid", "product_id", "weight", "norm"))
    asked = members
    if targets is not None:
        asked = members.join(targets.select("user_id").distinct(), "user_id", "left_semi")
    wanted = None if targets is None else materialize(asked.select(F.col("alike").alias("uid")).distinct())
    # The longest lists have the lowest numbers. Places are written, so that joins know them as the smaller side and entries stay in order.
    sizes = vectors.where(F.col("product_id").isNotNull()).groupBy("product_id").agg(F.count("*").alias("users"))
    products = materialize(number_rows(sizes, [F.desc("users"), F.asc("product_id")], "place"))
    entries = vectors.join(products.select("product_id", (F.col("place") - 1).alias("column")), "product_id")
    is_long = F.col("users") > max(block, SEEDS * (k + 1))
    long_lists, meets = products.agg(F.count_if(is_long), F.sum(F.col("users") * F.col("users"))).first()
    if wanted is not None:
        meets = _meets(vectors, sizes, wanted)
    if wanted is not None and meets <= vectors.count():
        met = _meet_in_blocks(_of(vectors, wanted), _others(vectors), ["product_id"])
        found = _sum_dots(met.where("uid <> other"))
    elif long_lists:
        found = _bounded(entries, wanted, long_lists, k)
    else:
        found = _full_lists(entries, wanted, meets or 0, k)
    # Ranked together with the user's own vector, so that the found ones are exchanged once.
    return _lists(_best(found.unionByName(_copies(members)), k + 1), asked, members, k)


_PAIR = ["uid", "other"]


def _members(raw: DataFrame, mode: str) -> DataFrame:
    """Every user with a number, the squared norm and the first user with the same vector.

    Numbers follow the order of the ids. Pairs are then pairs of numbers, which hash and sort
    faster than text; they live in this written table and never leave the plan.

    Vectors count as the same when norm, size and two independent 64-bit hashes agree.
    """
    entry = [F.col("product_id"), F.col("weight")]
    vector = ["norm", "size", "hash_1", "hash_2"]
    users = raw.groupBy("user_id").agg(
        F.sum(_square(mode)).alias("norm"),
        F.sum(F.col("weight") * F.col("weight")).alias("own"),
        F.count("*").alias("size"),
        F.bit_xor(F.xxhash64(*entry)).alias("hash_1"),
        F.bit_xor(F.xxhash64(F.lit("second"), *entry)).alias("hash_2"),
    )
    numbered = materialize(
        users.orderBy("user_id").withColumn("uid", F.monotonically_increasing_id())
    )
    copies = (
        numbered.groupBy(*vector)
        .agg(F.min("uid").alias("first"), F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
    )
    return materialize(
        numbered.join(copies, vector, "left").select(
            "uid", "user_id", "norm", "own", F.coalesce("first", "uid").alias("alike")
        )
    )


def _full_lists(entries: DataFrame, wanted: DataFrame | None, meets: int, k: int) -> DataFrame:
    """Best of the wanted users, or of everybody, where no list is long. ``meets`` entries of the wanted and of all users share a product.

    Lanes of users, which all others pass once. Blocks follow the numbers of users, so that ties go to the lowest.
    """
    placed, n, size = _placed(entries, [F.asc("uid")])
    lanes = lane_count(entries, meets, LANE_WORK, -(-size // LANE_ENTRIES))
    rows = min(max(n // (8 * lanes), 1), WIDE_ROWS)
    left, right = _packed(placed.withColumn("block", F.floor((F.col("place") - 1) / F.lit(rows))), wanted)
    return _single(meet_in_lanes(left, right, lanes, k))


def _bounded(entries: DataFrame, wanted: DataFrame | None, long_lists: int, k: int) -> DataFrame:
    """Best users where some lists are long.

    Users on long lists come first, and among them those with the shortest vectors: they are the strongest on their
    products, so the score to beat rises early and blocks that cannot reach it are passed over.
    """
    strongest = [F.desc(F.col("first") < long_lists), F.asc("norm"), F.asc("uid")]
    placed, _, size = _placed(entries, strongest)
    left, right = _packed(placed, wanted)
    return _single(meet(left, right, size, k, long_lists))


def _placed(entries: DataFrame, order: list[Column]) -> tuple[DataFrame, int, int]:
    """Entries with the place of their user along ``order``, and the number of users and of entries."""
    users = entries.groupBy("uid").agg(F.min("column").alias("first"), F.max("norm").alias("norm"), F.count("*").alias("size"))
    places = materialize(number_rows(users, order, "place").select("uid", "size", "place"))
    n, size = places.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    return entries.join(places.select("uid", "place"), "uid"), n, size


def _packed(placed: DataFrame, wanted: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Blocks of the wanted users, and of all."""
    if wanted is None:
        packed = materialize(pack(placed))
        return packed, packed
    placed = materialize(placed)
    return materialize(pack(placed.join(wanted, "uid", "left_semi"))), materialize(pack(placed))


def _single(met: DataFrame) -> DataFrame:
    """Best partners of every single user, with their dot products, from the blocks that its group or lane met."""
    return met.mapInArrow(partners_in_lane if "side" in met.columns else best_partners, FOUND)


def _meets(vectors: DataFrame, sizes: DataFrame, wanted: DataFrame) -> int:
    """Rows that a join of the wanted users with the lists of their products makes."""
    return _of(vectors, wanted).join(sizes, "product_id").agg(F.sum("users")).first()[0] or 0


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _of(vectors: DataFrame, users: DataFrame) -> DataFrame:
    return vectors.join(users.select("uid"), "uid", "left_semi")


def _others(vectors: DataFrame) -> DataFrame:
    return vectors.select(
        F.col("uid").alias("other"),
        "product_id",
        F.col("weight").alias("other_weight"),
        F.col("norm").alias("other_norm"),
    )


def _meet_in_blocks(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Users on the left with those on the right who agree in ``keys``, for lists of any length.

    The users on the left of a key are dealt into blocks, and each block meets all users on the
    right, so no task has a popular product to itself.
    """
    blocks = left.groupBy(*keys).agg(F.ceil(F.count("*") / F.lit(BLOCK_USERS)).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int")
    spread = left.join(blocks, keys).withColumn("block", block).drop("blocks")
    spread = spread.repartition(_tasks(left.sparkSession), *keys, "block")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    copies = right.join(blocks, keys).withColumn("block", every).drop("blocks")
    return spread.join(copies, [*keys, "block"]).drop("block")


def _sum_dots(met: DataFrame) -> DataFrame:
    return met.groupBy(*_PAIR).agg(
        F.sum(F.col("weight") * F.col("other_weight")).alias("dot"),
        F.max("norm").alias("norm"),
        F.max("other_norm").alias("other_norm"),
    )


def _best(dots: DataFrame, k: int) -> DataFrame:
    """The top ``k`` per user.

    The user's own norm is the same for all candidates, so ranking by ``dot^2 / other_norm`` equals
    ranking by cosine. It is one division of whole numbers: equal similarities compare equal.
    """
    dot = F.col("dot").cast("double")
    ranked = dots.select(
        *_PAIR,
        (dot * dot / F.col("other_norm")).alias("strength"),
        _cosine(F.col("dot"), F.col("norm"), F.col("other_norm")).alias("similarity_score"),
    )
    order = [F.desc("strength"), F.asc("other")]
    return top_n(ranked, ["uid"], order, k, "rank").drop("rank")


def _copies(members: DataFrame) -> DataFrame:
    """Vectors that several users have, as their own partners."""
    own = members.groupBy("alike").agg(F.count("*").alias("users"), F.first("own").alias("dot"), F.first("norm").alias("norm"))
    uid, norm = F.col("alike"), F.col("norm")
    return own.where(F.col("users") > 1).select(uid.alias("uid"), uid.alias("other"), "dot", "norm", norm.alias("other_norm"))


def _lists(found: DataFrame, asked: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """From the best vectors per vector to the best users per user.

    ``k + 1`` vectors, the user's own among them if others have it too, with their first ``k + 1`` users each are enough to
    choose from. A list that stays short is completed with the lowest user ids
    at similarity 0: at most ``k`` are taken already, the user's own included, so ``k + 1`` suffice.
    """
    copies = top_n(
        members.select(F.col("alike").alias("other"), "user_id"),
        ["other"],
        [F.asc("user_id")],
        k + 1,
        "place",
    ).select("other", F.col("user_id").alias("other_id"))
    candidates = found.join(copies, "other")
    order = [F.desc("strength"), F.asc("other_id")]
    entry = F.struct("rank", "other_id", "similarity_score")
    lists = (
        top_n(candidates, ["uid"], order, k + 1, "rank")
        .groupBy(F.col("uid").alias("alike"))
        .agg(F.array_sort(F.collect_list(entry)).alias("best"))
    )
    lowest = members.orderBy("user_id").limit(k + 1)
    spare = lowest.agg(F.array_sort(F.collect_list("user_id"))).scalar()
    empty = F.array().cast("array<struct<rank:int,other_id:string,similarity_score:double>>")
    best = F.coalesce("best", empty)
    others = F.filter(best, lambda item: item["other_id"] != F.col("user_id"))
    taken = F.transform("found", lambda item: item["other_id"])
    unused = F.array_except("spare", F.concat(taken, F.array("user_id")))
    filler = F.transform(
        F.slice(unused, F.lit(1), F.lit(k) - F.size("found")),
        lambda other: F.struct(
            F.lit(0).alias("rank"), other.alias("other_id"), F.lit(0.0).alias("similarity_score")
        ),
    )
    return (
        asked.select("user_id", "alike")
        .join(lists, "alike", "left")
        .select("user_id", F.slice(others, 1, k).alias("found"), spare.alias("spare"))
        .select("user_id", F.posexplode(F.concat("found", filler)).alias("i", "item"))
        .select(
            "user_id",
            F.col("item.other_id").alias("similar_user_id"),
            F.col("item.similarity_score").alias("similarity_score"),
            (F.col("i") + 1).cast("long").alias("rank"),
        )
    )

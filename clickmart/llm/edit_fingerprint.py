"""Document fingerprints by a randomised embedding of edit distance into Hamming distance.

All texts share one random walk: at step j the walk writes the character it stands on and goes on to the next
one if the coin for (j, character) says so. After an edit the walks of two texts meet again soon, so k edits
change about k * k of the written symbols at most, while unrelated texts never meet. A fingerprint holds the symbols
of fixed, randomly chosen steps, SAMPLES of them in each octave of steps, so texts of any length compare.
Bands of sampled symbols find candidates, which the whole fingerprints verify.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.llm.arrays import mix, pieces
from clickmart.llm.decontamination import may_be_seeds
from clickmart.llm.ids import numbered, whole
from clickmart.operators.materialize import materialize

SAMPLES = 32  # steps in each octave, one hexadecimal digit each
FIRST_OCTAVE = 5  # the first one covers the steps 0 to 31
BANDS = 12  # in each of the last two octaves that a text fills
BAND_SYMBOLS = 8
LEAST = 0.8  # likeness of near texts
FILTER_BITS = 25  # 4 MB: tells which keys may be those of a query
PIECE_BYTES = 8 << 20  # of texts whose walks go on together
END = "-"  # stands for a step after the end of a text

_steps: dict[int, np.ndarray] = {}
_classes: list[np.ndarray] = []


def sampled_steps(octave: int) -> np.ndarray:
    """The SAMPLES steps, sorted, of octave 0 (0 to 31), 1 (32 to 63), 2 (64 to 127) and so on."""
    if octave not in _steps:
        low = 0 if octave == 0 else 1 << (FIRST_OCTAVE + octave - 1)
        span = 1 << FIRST_OCTAVE if octave == 0 else low
        rng = np.random.default_rng([20240607, octave])
        _steps[octave] = low + np.sort(rng.choice(span, SAMPLES, replace=False))
    return _steps[octave]


def character_classes() -> list[np.ndarray]:
    """For each code point the digit that is written for it, and which of 64 coins it looks at."""
    if not _classes:
        code = mix(np.arange(0x110000, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        _classes.extend([(code >> np.uint64(60)).astype(np.uint8), (code & np.uint64(63)).astype(np.uint8)])
    return _classes


def walk(points: np.ndarray, offsets: np.ndarray) -> list[str]:
    """Fingerprint of each text, given the code points of all texts and their offsets.

    All walks take a step at a time. Those past their end drop out every 32 steps, and before symbols are noted.
    """
    digits, classes = character_classes()
    own = np.concatenate([classes[points], np.zeros(32, np.uint8)])
    digits = digits[points]
    rng = np.random.default_rng(20240607)
    alive = np.flatnonzero(np.diff(offsets) > 0)
    at, ends = offsets[alive].copy(), offsets[alive + 1]
    rows: list[np.ndarray] = []
    octave, step, taken = 0, 0, 0
    while True:
        noted = step == sampled_steps(octave)[taken]
        if noted or step % 32 == 0:
            inside = at < ends
            if not inside.all():
                alive, at, ends = alive[inside], at[inside], ends[inside]
            if not len(alive):
                break
        if noted:
            row = np.full(len(offsets) - 1, 16, np.uint8)
            row[alive] = digits[at]
            rows.append(row)
            taken += 1
            if taken == SAMPLES:
                octave, taken = octave + 1, 0
        if step % 4096 == 0:
            coins = rng.integers(0, 2, (4096, 64), dtype=np.uint8)
        at += coins[step % 4096][own[at]]
        step += 1
    signs = np.frombuffer(b"0123456789abcdef" + END.encode(), np.uint8)
    table = signs[np.array(rows, np.uint8).reshape(-1, len(offsets) - 1)].T
    return [np.ascontiguousarray(row).tobytes().decode().rstrip(END) for row in table]


def likeness(first: str, second: str) -> float:
    """Share of the sampled steps at which two fingerprints agree, an octave counting as many steps as it has.

    1 for two empty ones. Steps that both texts do not reach do not count.
    """
    width = max(len(first), len(second))
    if width == 0:
        return 1.0
    a = np.frombuffer(first.ljust(width, END).encode(), np.uint8)
    b = np.frombuffer(second.ljust(width, END).encode(), np.uint8)
    weight = np.exp2(np.maximum(np.arange(width) // SAMPLES - 1, 0))
    return float((weight * (a == b)).sum() / weight.sum())


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def fingerprint_texts(texts: list[str]) -> list[str]:
    return walk(*code_points(texts))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_chars, fingerprint) for every row of ``docs``, of the whole text; a null text is empty.

    Equal texts have equal fingerprints, the empty text the empty one. Ids keep their type. Rows are independent; other columns are not read.
    """

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text", PIECE_BYTES):
                texts = [t or "" for t in piece.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.array(fingerprint_texts(texts), pa.string()),
                    ],
                    names=["doc_id", "n_chars", "fingerprint"],
                )

    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, n_chars long, fingerprint string")


def band_places(octave: int) -> np.ndarray:
    """The symbols of an octave that each of its bands looks at."""
    rng = np.random.default_rng([20240608, octave])
    return np.stack([rng.choice(SAMPLES, BAND_SYMBOLS, replace=False) for _ in range(BANDS)])


def band_keys(fingerprint: str) -> list[int]:
    """A 64-bit key for every band of the last two octaves that a text fills; of a text that fills none, its fingerprint is one band.

    Two texts of likeness LEAST, with as many differences in each octave, agree in a band with a chance of 0.8 ** 8, and in one of
    two dozen with 0.99.
    """
    full = len(fingerprint) // SAMPLES
    while full and END in fingerprint[(full - 1) * SAMPLES : full * SAMPLES]:
        full -= 1
    if not full:
        return [int.from_bytes(hashlib.blake2b(fingerprint.encode(), digest_size=8).digest(), "little", signed=True)] if fingerprint else []
    symbols = np.frombuffer(fingerprint.encode(), np.uint8)
    keys = []
    for octave in range(max(0, full - 2), full):
        if octave not in _places:
            _places[octave] = band_places(octave)
        own = np.ascontiguousarray(symbols[octave * SAMPLES : (octave + 1) * SAMPLES][_places[octave]]).view(np.uint64)[:, 0]
        keys.append(mix(own ^ mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(octave << 8))))
    return np.concatenate(keys).view(np.int64).tolist()


_places: dict[int, np.ndarray] = {}


def with_keys(prints: DataFrame, filter_=None) -> DataFrame:
    """``prints`` (doc_id, fingerprint) with the array ``keys``; with a filter only those whose leading bits are set there."""

    def passing(keys: list[int]) -> list[int]:
        at = np.array(keys, np.int64).view(np.uint64) >> np.uint64(64 - FILTER_BITS)
        kept = filter_.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1
        return [k for k, keep in zip(keys, kept.tolist(), strict=True) if keep]

    def run(batches):
        for batch in batches:
            keys = [band_keys(f or "") for f in batch.column("fingerprint").to_pylist()]
            if filter_ is not None:
                keys = [passing(k) for k in keys]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.list_(pa.int64()))], names=[*batch.schema.names, "keys"])

    narrow = prints.select("doc_id", "fingerprint")
    return narrow.mapInArrow(run, T.StructType([*narrow.schema.fields, T.StructField("keys", T.ArrayType(T.LongType()))]))


def likenesses(batches):
    """Rows with the column ``likeness`` of ``asked`` and ``fingerprint``."""
    for batch in batches:
        pairs = zip(batch.column("asked").to_pylist(), batch.column("fingerprint").to_pylist(), strict=True)
        alike = pa.array([likeness(a, b) for a, b in pairs], pa.float64())
        yield pa.RecordBatch.from_arrays([*batch.columns, alike], names=[*batch.schema.names, "likeness"])


def near_classes(queries: DataFrame, prints: DataFrame, least: float = LEAST) -> DataFrame:
    """(asked, fingerprint, n, least_id, likeness) of distinct fingerprints that are alike by ``least`` or more and share a band.

    Both sides have (doc_id, fingerprint). n and least_id are the number of rows of ``prints`` with the fingerprint, and their smallest id. Rows
    with equal fingerprints are added up where they are found, so copies are not paired one by one. Empty fingerprints match nothing.
    """
    asked = with_keys(queries.where("fingerprint <> ''").select(F.lit(None).cast("long").alias("doc_id"), "fingerprint").distinct())
    asked = materialize(asked.select(F.xxhash64("fingerprint").alias("asked_id"), F.col("fingerprint").alias("asked"), "keys"))
    asked_keys = materialize(asked.select("asked_id", F.col("keys").alias("asked_keys"), F.explode("keys").alias("asked_key")))
    # Of fixed size, so it can be sent to all tasks; what it lets through besides, the join takes out.
    filter_ = prints.sparkSession.sparkContext.broadcast(may_be_seeds(asked_keys.select(F.col("asked_key").alias("hash")), FILTER_BITS))
    held = with_keys(prints.where("fingerprint <> ''"), filter_).where(F.size("keys") > 0)
    held = held.groupBy("fingerprint").agg(F.count("*").alias("n"), F.min("doc_id").alias("least_id"), F.first("keys").alias("keys"))
    held = held.select("*", F.explode("keys").alias("key"))
    # Two texts that share several bands meet in the first of them alone.
    first = F.get(F.array_intersect("keys", "asked_keys"), 0)
    classes = held.join(asked_keys, (F.col("key") == F.col("asked_key")) & (F.col("key") == first))
    classes = classes.join(asked.select("asked_id", "asked"), "asked_id").select("asked", "fingerprint", "n", "least_id")
    kinds = T.StructType([*classes.schema.fields, T.StructField("likeness", T.DoubleType())])
    return classes.mapInArrow(likenesses, kinds).where(F.col("likeness") >= least)


def near_texts(queries: DataFrame, prints: DataFrame, least: float = LEAST) -> DataFrame:
    """(query_id, doc_id, likeness) of all that ``near_classes`` finds, expanded to rows of both sides.

    Null ids are kept; a document is not paired with its own id.
    """
    pairs = near_classes(queries, prints, least).select("asked", "fingerprint", "likeness")
    return (
        queries.select(F.col("doc_id").alias("query_id"), F.col("fingerprint").alias("asked"))
        .join(pairs, "asked")
        .join(prints.select("doc_id", "fingerprint"), "fingerprint")
        .where("not (query_id <=> doc_id)")
        .select("query_id", "doc_id", "likeness")
    )


def edited(text: str, following: str) -> str:
    """``text`` with its last half, rounded down, replaced by as many first characters of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def compare_stream(batches):
    """Rows (id, text, ends), each range in order and closed by a row with ends = 1: fingerprints and likenesses.

    The last row of a slice waits for the first one of the next.
    """
    waiting = None
    for batch in batches:
        for piece in pieces(batch, "text", PIECE_BYTES):
            ids = piece.column("id").to_pylist()
            texts = piece.column("text").to_pylist()
            ends = piece.column("ends").to_pylist()
            if waiting:
                ids, texts, ends = [waiting[0], *ids], [waiting[1], *texts], [waiting[2], *ends]
            waiting = (ids[-1], texts[-1], ends[-1])
            rows = [i for i in range(len(ids) - 1) if not ends[i]]
            changed = [edited(texts[i], texts[i + 1]) for i in rows]
            prints = fingerprint_texts([*texts, *changed])
            after = prints[len(texts) :]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[i] for i in rows], pa.int64()),
                    pa.array([len(texts[i]) for i in rows], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
                    pa.array([prints[i] for i in rows], pa.string()),
                    pa.array(after, pa.string()),
                    pa.array([likeness(prints[i], x) for i, x in zip(rows, after, strict=True)], pa.float64()),
                    pa.array([likeness(prints[i], prints[i + 1]) for i in rows], pa.float64()),
                ],
                names=[part.split()[0] for part in RESULT.split(", ")],
            )


def deal(cuts: list[int]):
    """Adds the number of a row's range, from the highest ids on; null ids have the last one."""

    def run(batches):
        bounds = np.array(cuts, np.int64)
        for batch in batches:
            ids = batch.column("id")
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            found = len(bounds) - np.searchsorted(bounds, ids.fill_null(0).to_numpy(), "left")
            place = np.where(known, found, len(bounds) + 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.int64())], names=[*batch.schema.names, "part"])

    return run


def edited_likeness(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """How alike each document is to its own edited text and to the next document, by descending id.

    One row for every row of ``docs``: see RESULT. The edited text has its last half replaced by the beginning of the next
    document; the last document is followed by the first one. Ids are dealt into ranges by approximate quantiles, some for each
    shuffle partition; a range is read in order, and the first row of the next one is put at its end. Null ids come
    last; rows with the same id follow each other by a hash of their text. A single row is followed by itself. Null texts
    are empty. Ids that are no whole numbers go by their own order. Other columns are not read.
    """
    spark = docs.sparkSession
    if not whole(docs, id_column):
        placed, ids = numbered(docs.select(id_column, F.col(text_column).alias("text")), id_column, "id")
        found = edited_likeness(placed, "id", "text").withColumnRenamed("doc_id", "_number")
        named = found.join(ids.select(F.col("id").alias("_number"), F.col("_id").alias("doc_id")), "_number", "left")
        return named.select(*[part.split()[0] for part in RESULT.split(", ")])
    docs = docs.select(
        F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")
    )
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = [i / parts for i in range(1, parts)]
    cuts = docs.agg(F.percentile_approx("id", share, 20 * parts)).first()[0]
    cuts = sorted(set(cuts or []))  # fewer than parts, whatever the number of ids
    hash_ = F.xxhash64("text")
    placed = docs.mapInArrow(deal(cuts), "id long, text string, part long")
    narrow = docs.select("id", hash_.alias("h")).mapInArrow(deal(cuts), "id long, h long, part long")
    heads = narrow.groupBy("part").agg(F.max(F.struct("id", "h")).alias("head")).collect()
    heads = sorted((r["part"], r["head"]["id"], r["head"]["h"]) for r in heads)
    if not heads:
        return spark.createDataFrame([], RESULT)
    # Every range that has rows is closed by the head of the next one, the last by that of the first.
    closing = [(part, *heads[(i + 1) % len(heads)][1:]) for i, (part, _, _) in enumerate(heads)]
    closing = F.broadcast(spark.createDataFrame(closing, "part long, head long, h long"))
    last = docs.withColumn("h", hash_).join(
        closing.withColumnRenamed("h", "_h"), F.col("id").eqNullSafe(F.col("head")) & (F.col("h") == F.col("_h"))
    )
    last = last.groupBy("part").agg(F.first("id").alias("id"), F.first("text").alias("text"), F.lit(1).alias("ends"))
    rows = placed.withColumn("ends", F.lit(0)).unionByName(last)
    return (
        rows.repartition("part")
        .sortWithinPartitions("part", "ends", F.desc_nulls_last("id"), F.desc(hash_))
        .select("id", "text", "ends")
        .mapInArrow(compare_stream, RESULT)
    )

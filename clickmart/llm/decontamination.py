"""Benchmark decontamination by spaced-seed hashing.

A mask picks some tokens out of a short window and ignores the others, so a changed token on an ignored place
leaves the hash as it is. Hashes of the benchmark and of the training texts are joined, and around each
hit the aligned tokens are compared one by one. The masks are chosen so that a window of WINDOW tokens with
any TOLERANCE of them changed is always hit by at least one; so is a shorter text with as many changes as ``spare`` allows.
Items too short for a mask are found where all their tokens stand in a row: a seed of an own kind for each length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.llm.arrays import mix, pieces, words
from clickmart.llm.ids import numbered, row_key, whole
from clickmart.operators.materialize import materialize

WINDOW = 13
TOLERANCE = 2
LEAST_TOKENS = 3  # shorter items take no document out of a corpus
# No two places of a window of 13 break both masks in all of their positions.
MASKS = ("1101111", "110100111")
FILTER_BITS = 23  # 1 MB: tells which hashes of training texts may be benchmark hashes

# Tokens are runs of letters and digits. Of characters beyond ASCII those that are neither letter, mark nor number part
# tokens (``parted`` makes them spaces); in scripts without spaces every character is a token.
NO_LETTER = r"[\P{ASCII}&&\P{L}&&\P{M}&&\P{N}]+"
WITHOUT_SPACES = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsBopomofo}\p{IsYi}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}ー]"
PUNCTUATION = np.ones(256, bool)
PUNCTUATION[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def seed_hashes(tokens: np.ndarray, offsets: np.ndarray, mask: int) -> tuple[np.ndarray, np.ndarray]:
    """Places at which a mask fits into its text, and the hash of the tokens that it picks there."""
    pattern = MASKS[mask]
    n = len(tokens) - len(pattern) + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.full(n, mask + 1, np.uint64)
    for j, picked in enumerate(pattern):
        if picked == "1":
            total = total * np.uint64(0x9E3779B97F4A7C15) + tokens[j : j + n]
    ends = np.repeat(offsets[1:], np.diff(offsets))[:n]
    places = np.flatnonzero(np.arange(n) + len(pattern) <= ends)
    return places, mix(total[places])


def parted(text: Column) -> Column:
    """The text in lower case, with ASCII separators wherever tokens end; a text without characters beyond ASCII as it is."""
    low = F.lower(text.cast("string"))
    spaced = F.regexp_replace(F.regexp_replace(low, NO_LETTER, " "), WITHOUT_SPACES, " $0 ")
    return F.when(F.octet_length(low) == F.char_length(low), low).otherwise(spaced)


def short_hashes(tokens: np.ndarray, offsets: np.ndarray, length: int, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the runs of ``length`` tokens, or only of texts that are no longer than that."""
    n = len(tokens) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.full(n, short_kind(length) + 1, np.uint64)
    for j in range(length):
        total = total * np.uint64(0x9E3779B97F4A7C15) + tokens[j : j + n]
    if whole:
        places = offsets[:-1][np.diff(offsets) == length]
    else:
        ends = np.repeat(offsets[1:], np.diff(offsets))[:n]
        places = np.flatnonzero(np.arange(n) + length <= ends)
    return places, mix(total[places])


def short_kind(length: int) -> int:
    """What stands in the column mask for items of fewer tokens than any mask."""
    return len(MASKS) + length - 1


def around(tokens: np.ndarray, offsets: np.ndarray, places: np.ndarray, mask: int, outside: int) -> np.ndarray:
    """32-bit tokens that a window holding the mask may cover; ``outside`` stands where the text has none."""
    span = len(MASKS[mask])
    text = np.searchsorted(offsets, places, "right") - 1
    at = places[:, None] + np.arange(-(WINDOW - span), WINDOW)[None, :]
    inside = (at >= offsets[text][:, None]) & (at < offsets[text + 1][:, None])
    near = (tokens[np.clip(at, 0, len(tokens) - 1)] >> np.uint64(32)).astype(np.uint32) | np.uint32(2)
    return np.where(inside, near, np.uint32(outside))


def seeds(outside: int, filter_=None, lengths=()):
    """(id, hash, mask, place, text_tokens, near) of every seed of every text, or of those that pass the filter.

    ``lengths`` are those of short items to look for. Without a filter the texts are items, and only whole ones count as short.
    """

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                tokens, offsets = words(piece.column("text"), PUNCTUATION)
                ids = piece.column("id")
                for mask, length in [*((m, 0) for m in range(len(MASKS))), *((short_kind(n), n) for n in lengths)]:
                    if length:
                        places, hashes = short_hashes(tokens, offsets, length, filter_ is None)
                    else:
                        places, hashes = seed_hashes(tokens, offsets, mask)
                    if filter_ is not None:
                        bits = filter_.value
                        at = hashes >> np.uint64(64 - FILTER_BITS)
                        kept = bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1 == 1
                        places, hashes = places[kept], hashes[kept]
                    if not len(places):
                        continue
                    text = np.searchsorted(offsets, places, "right") - 1
                    if length:
                        near = (tokens[places[:, None] + np.arange(length)] >> np.uint64(32)).astype(np.uint32)
                    else:
                        near = around(tokens, offsets, places, mask, outside)
                    width = near.shape[1] * 4
                    flat = pa.py_buffer(np.ascontiguousarray(near).tobytes())
                    binary = pa.Array.from_buffers(
                        pa.binary(), len(places), [None, pa.py_buffer((np.arange(len(places) + 1) * width).astype(np.int32).tobytes()), flat]
                    )
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array(text)),
                            pa.array(hashes.view(np.int64)),
                            pa.array(np.full(len(places), mask, np.int32)),
                            pa.array((places - offsets[text]).astype(np.int64)),
                            pa.array((offsets[text + 1] - offsets[text]).astype(np.int64)),
                            binary,
                        ],
                        names=["id", "hash", "mask", "place", "text_tokens", "near"],
                    )

    return run


SEED_SCHEMA = "id long, hash long, mask int, place long, text_tokens long, near binary"


def spare(tokens):
    """Changes that a passage of so many tokens may have: 0 from 7 on, 1 from 10 on, TOLERANCE from WINDOW on."""
    return np.clip((tokens - min(map(len, MASKS))) // 3, 0, TOLERANCE)


def agreement(batches):
    """Hits whose best window agrees well enough, with its number of equal tokens."""
    for batch in batches:
        masks = batch.column("mask").to_numpy(zero_copy_only=False)
        needed = np.minimum(batch.column("item_tokens").to_numpy(zero_copy_only=False), WINDOW)
        best = np.zeros(batch.num_rows, np.int64)
        for mask in np.unique(masks):
            rows = np.flatnonzero(masks == mask)
            pick = pa.array(rows)
            sides = [
                np.frombuffer(b"".join(batch.column(c).take(pick).to_pylist()), np.uint32).reshape(len(rows), -1)
                for c in ("near", "item_near")
            ]
            if mask >= len(MASKS):
                best[rows] = np.where((sides[0] == sides[1]).all(axis=1), needed[rows], 0)
                continue
            sums = []
            for what in (sides[0] == sides[1], (sides[0] != 0) & (sides[1] != 1)):
                total = np.concatenate([np.zeros((len(rows), 1), np.int64), np.cumsum(what, axis=1)], axis=1)
                sums.append(total[:, WINDOW:] - total[:, :-WINDOW])
            whole = sums[1] == needed[rows][:, None]  # as many places as needed lie within both texts
            best[rows] = np.where(whole, sums[0], 0).max(axis=1)
        kept = pa.array((best > 0) & (best >= needed - spare(needed)))
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c).filter(kept) for c in ("id", "class", "place")),
                pa.array(best).filter(kept),
            ],
            names=["id", "class", "place", "equal"],
        )


def may_be_seeds(hashes: DataFrame, filter_bits: int = FILTER_BITS) -> np.ndarray:
    """Bit array of fixed size with a bit set for the leading bits of each hash; put together by the cluster."""
    at = F.shiftrightunsigned("hash", 64 - filter_bits)
    rows = hashes.select(at.alias("at")).selectExpr(
        "shiftrightunsigned(at, 6) as word", "shiftleft(1L, cast(at & 63 as int)) as bit"
    )
    table = np.zeros(1 << (filter_bits - 6), np.int64)
    for row in rows.groupBy("word").agg(F.bit_or("bit").alias("bits")).toLocalIterator():
        table[row["word"]] = row["bits"]
    return table.view(np.uint8)


def class_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str,
    text_column: str,
    item_column: str,
    item_text_column: str,
    short: range,
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, class, equal, hits, first, last) and (class, item_id); ``short`` are the lengths of short items to find.

    A class is what seeds of items look like: hash, mask, tokens around and tokens of the item. Each is searched once, however
    many items have it.
    """
    items = benchmark.select(F.col(item_column).cast("long").alias("id"), parted(F.col(item_text_column)).alias("text"))
    alike = ["hash", "mask", "item_near", "item_tokens"]
    items = items.mapInArrow(seeds(outside=1, lengths=short), SEED_SCHEMA).withColumnsRenamed({"near": "item_near", "text_tokens": "item_tokens"})
    items = materialize(items.select("id", *alike).distinct())
    # Written, so that a class has the same number for all readers.
    classes = materialize(items.select(*alike).distinct().withColumn("class", F.monotonically_increasing_id()))
    members = items.join(classes, alike).select("class", F.col("id").alias("item_id"))
    filter_ = docs.sparkSession.sparkContext.broadcast(may_be_seeds(classes.select("hash")))
    # A row for each length that short items have, six at most.
    there = classes.where(F.col("mask") >= len(MASKS)).select("item_tokens").distinct().collect()
    lengths = sorted(r["item_tokens"] for r in there)
    texts = docs.select(F.col(id_column).cast("long").alias("id"), parted(F.col(text_column)).alias("text"))
    # Written, so that finding and comparing do not need two workers for each task at the same time.
    found = materialize(texts.mapInArrow(seeds(0, filter_, lengths), SEED_SCHEMA).drop("text_tokens"))
    hits = found.join(classes, ["hash", "mask"])
    agreed = hits.mapInArrow(agreement, "id long, class long, place long, equal long")
    agreed = agreed.groupBy(F.col("id").alias("doc_id"), "class").agg(
        F.max("equal").alias("equal"), F.count("*").alias("hits"), F.min("place").alias("first"), F.max("place").alias("last")
    )
    return agreed, members


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    short_items: bool = False,
) -> DataFrame:
    """(doc_id, item_id, equal_tokens, hits, first_token, last_token): documents that hold a passage of an item.

    Tokens are runs of letters and digits, lower-cased; in scripts without spaces each character is one. A document leaks an item where WINDOW successive
    tokens of both agree in all but TOLERANCE at most; an item of fewer tokens has to be there whole, with ``spare`` changes at most.
    Items of fewer tokens than the shorter mask leak where a document holds all their tokens in a row if ``short_items``,
    else nowhere, as they cannot be told from chance. Items that
    share passages are each reported. A null text is empty; a null id leaks under a null id; repeated rows give one result row
    for each document and item. Ids keep their type. Other columns are not read. Empty tables give an empty result.
    """
    for frame, column, text, other in ((docs, id_column, text_column, False), (benchmark, item_column, item_text_column, True)):
        if not whole(frame, column):
            placed, ids = numbered(frame.select(column, F.col(text).alias("text")), column, "n")
            if other:
                found = leaks(docs, placed, id_column, text_column, "n", "text", short_items)
            else:
                found = leaks(placed, benchmark, "n", "text", item_column, item_text_column, short_items)
            name = "item_id" if other else "doc_id"
            columns = found.columns
            return found.withColumnRenamed(name, "n").join(ids.withColumnRenamed("_id", name), "n", "left").select(*columns)
    short = range(1, min(map(len, MASKS)) if short_items else 1)
    agreed, members = class_leaks(docs, benchmark, id_column, text_column, item_column, item_text_column, short)
    # A class that many documents and items share has many rows; Spark splits them, as the next grouping deals them anew.
    return (
        agreed.join(members, "class")
        .groupBy("doc_id", "item_id")
        .agg(
            F.max("equal").alias("equal_tokens"),
            F.sum("hits").alias("hits"),
            F.min("first").alias("first_token"),
            F.max("last").alias("last_token"),
        )
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_tokens: int = LEAST_TOKENS
) -> DataFrame:
    """``docs`` without the rows that leak an item of ``least_tokens`` tokens or more; all columns stay.

    Shorter items are words that clean texts use too: ``leaks`` reports them, but they take no document. Rows are told apart by a hash of id and
    text, so ids may be null or repeat, and a clean row stays whatever its namesake holds.
    """
    key = row_key(id_column, text_column)
    keyed = docs.select(key.alias("key"), F.col(text_column).alias("text"))
    items = benchmark.select(F.xxhash64("text").alias("item_id"), "text")
    agreed, _ = class_leaks(keyed, items, "key", "text", "item_id", "text", range(least_tokens, min(map(len, MASKS))))
    found = agreed.select(F.col("doc_id").alias("_leak")).distinct()
    return docs.join(found, key == found["_leak"], "left_anti")

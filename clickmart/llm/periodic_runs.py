"""Periodic runs of words, found by internal pattern matching, and texts with their repetitions collapsed.

A run is a stretch of words with smallest period q, at least four periods and six words long, that no word beside
it continues. Periods of one and two words are found by comparing words with their neighbours. For longer ones
each text is cut into dyadic blocks, of 4, 8, 16 words and so on. A block of L words asks for its next and its last
occurrence among the L places beside it: the interval of a suffix array that holds the suffixes starting with
the block, and a wavelet matrix over that array which gives the nearest place. Where L / 2 < q <= L, a block
within a run of period q holds a whole period, so its nearest occurrence in the run is q words away and no
nearer; occurrences at the same distance in block after block form a progression. Its distance is the candidate
period, its stretch is extended by comparing words, and what is long enough is a run. Nothing is hashed: words
are numbered by their bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.llm.arrays import pieces

LEAST_WORDS = 6
LEAST_PERIODS = 4
SHORTEST_BLOCK = 2  # as a power of two
NEVER = 127  # suffixes that no level has parted
SLICE_BYTES = 1 << 19


class WaveletMatrix:
    """Counts and order statistics of ranges of an array, for many ranges at once."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.zeros_before, self.zeros = [], []
        for bit in reversed(range(self.bits)):
            zero = (values >> bit) & 1 == 0
            before = np.zeros(len(values) + 1, np.int64)
            np.cumsum(zero, out=before[1:])
            self.zeros_before.append(before)
            self.zeros.append(int(before[-1]))
            values = np.concatenate([values[zero], values[~zero]])

    def below(self, left: np.ndarray, right: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many values of each range are below its limit."""
        found = np.zeros(len(left), np.int64)
        for level, (before, zeros) in enumerate(zip(self.zeros_before, self.zeros, strict=True)):
            one = (limit >> (self.bits - 1 - level)) & 1 == 1
            zeros_left, zeros_right = before[left], before[right]
            found += np.where(one, zeros_right - zeros_left, 0)
            left = np.where(one, zeros + left - zeros_left, zeros_left)
            right = np.where(one, zeros + right - zeros_right, zeros_right)
        return found

    def at_place(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The value of each range that ``place`` values of it are below."""
        value = np.zeros(len(left), np.int64)
        for level, (before, zeros) in enumerate(zip(self.zeros_before, self.zeros, strict=True)):
            zeros_left, zeros_right = before[left], before[right]
            one = place >= zeros_right - zeros_left
            value |= one.astype(np.int64) << (self.bits - 1 - level)
            place = np.where(one, place - (zeros_right - zeros_left), place)
            left = np.where(one, zeros + left - zeros_left, zeros_left)
            right = np.where(one, zeros + right - zeros_right, zeros_right)
        return value


def suffix_array(symbols: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first words, and the level that parts each from the one before it.

    ``ends`` and ``lengths`` are those of each symbol's text. Suffixes parted at level k differ within their first 2 ** k words and
    not within half as many. Levels go on for each text while it can hold four periods of such a block;
    what is still together then stays in any order.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    fresh = np.ones(n, bool)
    fresh[1:] = symbols[order[1:]] != symbols[order[:-1]]
    parted = np.where(fresh, 0, NEVER).astype(np.int8)
    first = np.flatnonzero(fresh)
    sizes = np.diff(first, append=n)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(first, sizes)
    slots = np.flatnonzero(np.repeat(sizes > 1, sizes))
    level = 0
    while len(slots):
        suffix = order[slots]
        after = suffix + 2**level
        second = np.where(after < ends[suffix], rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[suffix] * (n + 1) + second
        by_key = np.argsort(key, kind="stable")
        key, suffix = key[by_key], suffix[by_key]
        order[slots] = suffix
        fresh = np.ones(len(slots), bool)
        fresh[1:] = key[1:] != key[:-1]
        level += 1
        parted[slots[fresh & (parted[slots] == NEVER)]] = level
        first = np.flatnonzero(fresh)
        sizes = np.diff(first, append=len(slots))
        rank[suffix] = np.repeat(slots[first], sizes)
        slots = slots[np.repeat(sizes > 1, sizes) & (lengths[suffix] > 2 ** (level + 2))]
    return order, parted


def near_occurrences(
    order: np.ndarray, parted: np.ndarray, tree: WaveletMatrix, level: int, ends: np.ndarray, long_enough: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) for dyadic blocks that occur again beside themselves: the earlier of both places."""
    length = 2**level
    first = np.flatnonzero(parted <= level)
    bounds = np.append(first, len(order))
    asked = np.flatnonzero((order % length == 0) & long_enough[order])
    group = np.searchsorted(first, asked, "right") - 1
    left, right = bounds[group], bounds[group + 1]
    several = right - left > 1
    asked, left, right = asked[several], left[several], right[several]
    block = order[asked]
    place = tree.below(left, right, block)
    later, earlier = place + 1 < right - left, place > 0
    following = tree.at_place(left[later], right[later], place[later] + 1)
    previous = tree.at_place(left[earlier], right[earlier], place[earlier] - 1)
    start = np.concatenate([block[later], previous])
    distance = np.concatenate([following - block[later], block[earlier] - previous])
    near = (distance > length // 2) & (distance <= length)
    return start[near], distance[near]


def extended(
    symbols: np.ndarray, left: np.ndarray, right: np.ndarray, period: np.ndarray, reach: int
) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of the given periods, made longer on both sides by up to ``reach`` words while words agree."""
    n = len(symbols)
    step = np.arange(reach)
    ahead = right[:, None] + step
    agree = (ahead < n) & (symbols[np.minimum(ahead, n - 1)] == symbols[np.minimum(ahead, n - 1) - period[:, None]])
    right = right + np.where(agree.all(1), reach, (~agree).argmax(1))
    back = left[:, None] - 1 - step
    agree = (back >= 0) & (symbols[np.maximum(back, 0)] == symbols[np.minimum(np.maximum(back, 0) + period[:, None], n - 1)])
    return left - np.where(agree.all(1), reach, (~agree).argmax(1)), right


def short_periods(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the runs of period one and two."""
    found = []
    for period in (1, 2):
        same = np.concatenate([[False], symbols[period:] == symbols[:-period], [False]])
        turns = np.flatnonzero(same[1:] != same[:-1])
        start, end = turns[::2], turns[1::2] + period
        if period == 2 and len(start):
            whole = symbols[start] != symbols[start + 1]
            start, end = start[whole], end[whole]
        found.append((start, end, np.full(len(start), period)))
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def runs(symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs, by start and period. Symbols are numbers; those of two texts always differ.

    ``offsets`` are the places where texts start, and the end of the last one.
    """
    sizes = np.diff(offsets)
    longest = int(sizes.max(initial=0))
    if longest < LEAST_WORDS:
        return (np.zeros(0, np.int64),) * 3
    found = [short_periods(symbols)]
    ends, lengths = np.repeat(offsets[1:], sizes), np.repeat(sizes, sizes)
    order, parted = suffix_array(symbols, ends, lengths)
    first = np.flatnonzero(parted <= SHORTEST_BLOCK)
    group_sizes = np.diff(first, append=len(order))
    again = np.repeat(group_sizes > 1, group_sizes)  # only blocks that occur again can be found again
    order, parted = order[again], parted[again]
    if len(order):
        tree = WaveletMatrix(order)
        level = SHORTEST_BLOCK
        while 2 ** (level + 1) < longest:
            length = 2**level
            start, period = near_occurrences(order, parted, tree, level, ends, lengths > 2 * length)
            if len(start):
                by_period = np.lexsort((start, period))
                start, period = start[by_period], period[by_period]
                new = np.ones(len(start), bool)  # progressions of blocks at the same distance
                new[1:] = (period[1:] != period[:-1]) | (start[1:] - start[:-1] > length)
                head = np.flatnonzero(new)
                tail = np.append(head[1:], len(start)) - 1
                left, right = extended(symbols, start[head], start[tail] + period[tail] + length, period[head], length + 1)
                found.append((left, right, period[head]))
            level += 1
    left, right, period = (np.concatenate(part) for part in zip(*found, strict=True))
    enough = right - left >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    place = np.unique(np.stack([left, period, right], 1)[enough], axis=0)
    return place[:, 0], place[:, 2], place[:, 1]


def collapse(words: list[bytes], start: np.ndarray, end: np.ndarray, period: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not len(start):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, end, -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)])


def runs_of_texts(texts: list[bytes]) -> list[tuple[int, list[tuple[int, int, int]], bytes]]:
    """(words, [(start, length, period)], collapsed text) for each text."""
    words = [text.split() for text in texts]  # bytes part at x20 and x09 to x0D
    sizes = np.array([len(w) for w in words], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    if offsets[-1] == 0:
        return [(0, [], b"")] * len(texts)
    coded = pa.array([w for some in words for w in some], pa.large_binary()).dictionary_encode()
    symbols = coded.indices.to_numpy().astype(np.int64) + len(coded.dictionary) * np.repeat(np.arange(len(texts)), sizes)
    start, end, period = runs(symbols, offsets)
    at = np.searchsorted(start, offsets)
    out = []
    for i, own in enumerate(words):
        part = slice(at[i], at[i + 1])
        s, e, q = start[part] - offsets[i], end[part] - offsets[i], period[part]
        out.append((len(own), list(zip(s.tolist(), (e - s).tolist(), q.tolist(), strict=True)), collapse(own, s, e, q)))
    return out


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_words, runs array of (start, length, period), collapsed) for every row of ``docs``.

    Runs are sorted by start and period; places are word numbers from 0. ``collapsed`` is the text without the words
    that a run holds after its first period, joined by one space; runs may overlap. A null or empty text, or one of
    white space, has no words, no runs and an empty collapsed text. Ids keep their type and may be null or repeat: each
    row is judged alone. Other columns, whatever their names, are left out; an empty table gives an empty result.
    Texts are worked on whole, in slices of about 512 KB; a longer text is a slice of its own and takes some 100 bytes a
    word. There is no shuffle.
    """

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text", SLICE_BYTES):
                found = runs_of_texts([t.encode() if t else b"" for t in piece.column("text").to_pylist()])
                flat = [r for _, some, _ in found for r in some]
                places = pa.StructArray.from_arrays(
                    [pa.array([r[i] for r in flat], pa.int64()) for i in range(3)], fields=list(RUN)
                )
                ends = np.cumsum([0] + [len(some) for _, some, _ in found])
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("id"),
                        pa.array([n for n, _, _ in found], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), places),
                        pa.array([text.decode() for _, _, text in found], pa.string()),
                    ],
                    names=["id", "n_words", "runs", "collapsed"],
                )

    narrow = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return narrow.mapInArrow(run, schema).withColumnRenamed("id", id_column)

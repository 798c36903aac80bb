"""Texts of an Arrow batch as flat numpy arrays: words, shingles and their hashes, without a Python string."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18

# Bytes that separate words, x20 and x09 to x0D.
WHITE_SPACE = np.zeros(256, bool)
WHITE_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

BYTE_CODES = np.random.default_rng(20240101).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 2**64)
SHINGLE_BASE = 0xD1342543DE82EF95

_powers: dict[int, np.ndarray] = {}


def pieces(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts have about ``limit`` bytes; a longer text is a slice of its own.

    After the last one memory that is free goes back to the system, as workers live on for other tasks.
    """
    if not batch.num_rows:
        return
    _, offsets = utf8(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        end = max(end, at + 1)
        yield batch.slice(at, end - at)
        at = end
    give_back()


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library can
        ctypes.CDLL(None).malloc_trim(0)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each; a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8))[at[0] : at[-1]], at - at[0]


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64; kept up to the usual size of a chunk."""
    kept = _powers.get(base)
    if kept is None or len(kept) < n:
        full = np.full(max(n, 1024), base, np.uint64)
        full[0] = 1
        kept = np.cumprod(full)
        if len(kept) <= 4 * CHUNK_BYTES:
            _powers[base] = kept
    return kept[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all of them."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _segment(data: np.ndarray, breaks: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words in one stretch of bytes; ``breaks`` are offsets that also part words."""
    inside = ~separators[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    before[breaks] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[breaks[breaks > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODES[LOWER[data]] * powers(BASE, len(data)), out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * powers(BASE_INVERSE, len(data))[starts])


def words(
    column: pa.Array, separators: np.ndarray = WHITE_SPACE, limit: int = 2 * CHUNK_BYTES
) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, A-Z lower-cased, and for each text the offsets of its words.

    Works in stretches of about ``limit`` bytes that end at a separator, so a very long text needs little
    more than its own size and eight bytes a word.
    """
    data, offsets = utf8(column)
    found, at = [], 0
    while at < len(data):
        end = min(len(data), at + limit)
        while end < len(data):  # look for a separator or the end of a text
            ahead = separators[data[end : end + limit]]
            stop = int(np.searchsorted(offsets, end))
            near = end + (int(ahead.argmax()) if ahead.any() else len(ahead))
            near = min(near, int(offsets[stop]) if stop < len(offsets) else len(data))
            done = near < end + len(ahead) or near == len(data)
            end = near
            if done:
                break
        breaks = offsets[(offsets >= at) & (offsets < end)] - at
        starts, hashes = _segment(data[at:end], breaks, separators)
        found.append((starts + at, hashes))
        at = end
    if not found:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    starts = np.concatenate([s for s, _ in found])
    return np.concatenate([h for _, h in found]), np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words and offsets by text; a shorter text is one run, an empty one none."""
    n = len(hashes)
    ends = np.repeat(offsets[1:], np.diff(offsets))
    total = np.zeros(n, np.uint64)
    place = np.arange(n)
    factor = 1
    for j in range(k):
        part = np.zeros(n, np.uint64)
        part[: max(0, n - j)] = hashes[j:]
        part[place + j >= ends] = 0
        total += part * np.uint64(factor)
        factor = factor * SHINGLE_BASE % 2**64
    first = np.zeros(n, bool)
    first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    whole = (place + k <= ends) | first
    kept = np.concatenate([[0], np.cumsum(whole)])
    return mix(total[whole]), kept[offsets]

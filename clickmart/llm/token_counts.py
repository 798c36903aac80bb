"""Token counts of a byte-level BPE tokenizer by rank-synchronous merging of ragged arrays.

The pre-tokens of many texts stand as rows of symbols in one flat array. In each round every row applies its
own lowest-ranked pair wherever it occurs, all rows at once, until no row has a pair that the tokenizer
merges. What counts is the number of symbols that are left.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.llm.arrays import pieces

# How byte-level BPE parts a text, and the code points whose classes every Unicode version since 2018 shares.
PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SETTLED = r"[\x00-\u052f\u0e00-\u0e7f\u2010-\u2070\u20a0-\u20bf\u3041-\u3096\u30a0-\u30ff\u4e00-\u9fa5\uac00-\ud7a3]*"
KEPT_WORDS = 200_000
NO_RANK = np.iinfo(np.int64).max

_loaded: dict[str, tuple] = {}


def byte_symbols() -> dict[str, int]:
    """The characters by which byte-level BPE files write bytes: printable ones as they are, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class MergeTable:
    """Rank and result of every pair of symbols, by binary search in one sorted array."""

    def __init__(self, vocabulary: dict[str, int], merges: list):
        of_byte = byte_symbols()
        self.start = np.zeros(256, np.int64)
        for character, byte in of_byte.items():
            self.start[byte] = vocabulary[character]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left = np.array([vocabulary[a] for a, _ in pairs], np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        key = left << 32 | right
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.made = key[order], order.astype(np.int64), made[order]

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of the pairs, NO_RANK where they do not merge, and their places in the table."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank[at], NO_RANK), at


def merge_counts(table: MergeTable, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Symbols left of each row, given the bytes of all rows and the length of each."""
    counts = np.ones(len(sizes), np.int64)
    counts[sizes == 0] = 0
    rows = np.flatnonzero(sizes > 1)
    symbols = table.start[data[np.repeat(sizes > 1, sizes)]]
    sizes = sizes[rows]
    while len(rows):
        ends = np.cumsum(sizes)
        starts = ends - sizes
        rank = np.full(len(symbols), NO_RANK)
        at = np.zeros(len(symbols), np.int64)
        rank[:-1], at[:-1] = table.find(symbols[:-1], symbols[1:])
        rank[ends - 1] = NO_RANK  # the last symbol of a row has no partner
        lowest = np.minimum.reduceat(rank, starts)
        done = lowest == NO_RANK
        counts[rows[done]] = sizes[done]
        chosen = (rank == np.repeat(lowest, sizes)) & (rank != NO_RANK)
        # of overlapping occurrences, as in aaa, every other one from the left counts
        follows = chosen.copy()
        follows[0] = False
        follows[1:] &= chosen[:-1]
        if follows.any():
            first = np.flatnonzero(chosen & ~follows)
            place = np.flatnonzero(chosen)
            run = np.searchsorted(first, place, "right") - 1
            chosen[place[(place - first[run]) % 2 == 1]] = False
        symbols = symbols.copy()
        symbols[chosen] = table.made[at[chosen]]
        gone = np.zeros(len(symbols), bool)
        gone[1:] = chosen[:-1]
        stay = ~gone & ~np.repeat(done, sizes)
        sizes = (sizes - np.add.reduceat(gone, starts))[~done]
        rows, symbols = rows[~done], symbols[stay]
        single = sizes == 1
        if single.any():  # counted as one from the beginning
            symbols = symbols[~np.repeat(single, sizes)]
            rows, sizes = rows[~single], sizes[~single]
    return counts


def load(path: str) -> tuple[MergeTable, list[str], Callable]:
    """Merge table, special strings and pre-tokenizer of a byte-level BPE file; read once by each worker."""
    if path not in _loaded:
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("a byte-level BPE without normalizer or added space is needed")
        specials = [t["content"] for t in spec["added_tokens"]]
        pattern, settled = regex.compile(PRE_TOKENS), regex.compile(SETTLED)
        library = Tokenizer.from_file(path).pre_tokenizer

        def parts(text: str) -> list[str]:
            if settled.fullmatch(text):
                return pattern.findall(text)
            # characters that were given a class lately: as the library's own tables have them
            return [text[a:b] for _, (a, b) in library.pre_tokenize_str(text)]

        _loaded[path] = MergeTable(spec["model"]["vocab"], spec["model"]["merges"]), specials, parts
    return _loaded[path]


def count_texts(path: str, texts: list[str], known: dict[str, int]) -> list[int]:
    """Tokens of each text. ``known`` remembers counts of pre-tokens between calls, up to KEPT_WORDS."""
    import regex

    table, specials, parts = load(path)
    splitter = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None
    totals, split = [], []
    for text in texts:
        special = len(splitter.findall(text)) if splitter else 0
        found = []
        for stretch in splitter.split(text) if special else [text]:
            found += parts(stretch)
        split.append(found)
        totals.append(special)
    new = list({word for found in split for word in found if word not in known})
    if new:
        encoded = [word.encode() for word in new]
        sizes = np.array([len(x) for x in encoded], np.int64)
        data = np.frombuffer(b"".join(encoded), np.uint8)
        known.update(zip(new, merge_counts(table, data, sizes).tolist(), strict=True))
    totals = [n + sum(map(known.__getitem__, found)) for n, found in zip(totals, split, strict=True)]
    if len(known) > KEPT_WORDS:
        known.clear()
    return totals


def token_counts(
    docs: DataFrame, tokenizer: str, limit: int = 512, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``, as the tokenizers library counts them.

    ``tokenizer`` is the path of a byte-level BPE file on every worker. No begin or end tokens are added; special strings within a text are one
    token each. A null text is empty and has 0 bytes and tokens. Texts of any length are counted whole; the
    work is done in slices of about 256 KB of texts. Ids keep their type. Rows are independent, so repeated rows, null ids and other columns
    change nothing, and an empty table gives an empty result.
    """

    def run(batches):
        known: dict[str, int] = {}
        for batch in batches:
            for piece in pieces(batch, "text"):
                texts = [t or "" for t in piece.column("text").to_pylist()]
                counts = count_texts(tokenizer, texts, known)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        pa.array([len(t) if t.isascii() else len(t.encode()) for t in texts], pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array([n > limit for n in counts], pa.bool_()),
                    ],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")

"""The trie of conversation prefixes, built from range-partitioned, sorted conversations and a skeleton of splitters.

A conversation is the path of its turns, each named by a 128-bit digest of role and text. Paths sampled by their
length give splitters, which part all paths into ranges. The prefixes of the splitters are the skeleton: only their nodes can
have members in several ranges, and every task knows the splitters. A task walks its sorted paths with one open node
for each depth and finishes all other nodes by itself; of a skeleton node it gives its part. The parts are
added up, and the skeleton, whose size has a fixed bound, is finished by the same walk.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.llm.sharding import drawn, rank_among
from clickmart.operators.materialize import materialize

WORD = r"[^\x20\x09-\x0D]+"
TURN = 16  # bytes of a turn in a path
IDS = 4096  # ids of equal conversations that one row holds
RANGE_TURNS = 50_000
MOST_RANGES = 1024
SKELETON_TURNS = 1 << 17  # bound on the turns of all splitters
SAMPLED = 32  # paths drawn for a range
ROWS = 8192  # of a batch
SPREAD = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
WALKED = f"{SPREAD}, words long, prefix binary, above binary, seq long"


def conversation_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turns array of (key, words)) from rows (conv_id, turn, role, text).

    Turns are ordered by turn, null first, then by key; the key is the MD5 of the length of the role, the role and the text,
    where null is empty. Repeated rows are turns of their own. Rows without a whole-number conv_id belong to no conversation
    and are left out. A conversation is one row: 40 bytes a turn, its texts are not kept.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    turn = F.col("turn")
    narrow = turns.select(
        F.col("conv_id").try_cast("long").alias("conv_id"),
        F.struct(turn.isNotNull().alias("given"), turn.alias("turn"), key.alias("key"), F.regexp_count(text, F.lit(WORD)).alias("words")).alias("t"),
    )
    listed = narrow.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return listed.select("conv_id", F.transform("turns", lambda t: F.struct(t["key"], t["words"])).alias("turns"))


def shared_turns(a: bytes, b: bytes) -> int:
    """How many first turns two paths have in common."""
    low, high = 0, min(len(a), len(b)) // TURN
    while low < high:
        middle = (low + high + 1) // 2
        if a[low * TURN : middle * TURN] == b[low * TURN : middle * TURN]:
            low = middle
        else:
            high = middle - 1
    return low


@dataclass(slots=True)
class Node:
    words: int
    skeleton: bool
    least: int | None = None
    n: int = 0
    children: int = 0
    leaves: int = 0
    saved: int = 0
    ends: object = None

    def gains(self, n: int, least: int | None, children: int, leaves: int, saved: int) -> None:
        self.n += n
        if self.least is None or (least is not None and least < self.least):
            self.least = least
        self.children += children
        self.leaves += leaves
        self.saved += saved


class Walk:
    """One pass over sorted paths with a node open for each depth; ``rows`` are those of WALKED, children first."""

    def __init__(self, splitters: list[bytes] | None):
        self.splitters = splitters  # None: the skeleton itself is walked, nothing is left open
        self.open: list[Node] = []
        self.path: bytes = b""
        self.range: int | None = None
        self.rows: list[tuple] = []
        self.seq = 0

    def close(self, kept: int) -> None:
        while len(self.open) > kept:
            node, depth = self.open.pop(), len(self.open)
            ends = node.ends.hexdigest() if hasattr(node.ends, "hexdigest") else node.ends
            prefix = above = None
            if node.skeleton:
                prefix = self.path[: depth * TURN]
            else:
                node.leaves = node.leaves if node.children else 1
                node.saved += (node.n - 1) * node.words
                ends = ends or hashlib.sha256().hexdigest()
                if depth:
                    self.open[-1].gains(node.n, node.least, 1, node.leaves, node.saved)
                    if self.open[-1].skeleton:
                        above = hashlib.md5(self.path[: (depth - 1) * TURN]).digest()
                if self.splitters is None:
                    prefix = self.path[: depth * TURN]
            self.rows.append(
                (node.least, depth, None, node.n, node.children, node.leaves, node.saved, ends, node.words, prefix, above, self.seq)
            )
            self.seq += 1

    def reach(self, place: int, path: bytes, words: list[int]) -> Node:
        """The node of ``path``; ``words`` are those of its last turns."""
        if place != self.range:
            self.close(0)
            self.range = place
        elif self.open:
            self.close(shared_turns(self.path, path) + 1)
        depth, known = len(path) // TURN, -1
        if self.splitters is not None and len(self.open) <= depth:
            beside = self.splitters[max(0, place - 1) : place + 1]
            known = max([0, *(shared_turns(path, s) for s in beside)])
        for d in range(len(self.open), depth + 1):
            self.open.append(Node(words[d - 1 - depth + len(words)] if d else 0, d <= known))
        self.path = path
        return self.open[-1]

    def take(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def batches_of(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= ROWS:
            yield batch_of(held, schema)
            held = []
    if held:
        yield batch_of(held, schema)


LONGS = [pa.int64()] * 7
WALKED_SCHEMA = pa.schema(
    list(
        zip(
            [part.split()[0] for part in WALKED.split(", ")],
            [*LONGS, pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.int64()],
            strict=True,
        )
    )
)


def grouped_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal paths that stand together as one row with their ids, IDS at most."""
    schema = pa.schema([("path", pa.binary()), ("words", pa.list_(pa.int32())), ("first", pa.int64()), ("n", pa.int64()), ("ids", pa.string())])

    def rows():
        path, words, ids = None, None, []
        for batch in batches:
            for c, p, w in zip(*(batch.column(name).to_pylist() for name in ("conv_id", "path", "words")), strict=True):
                if p != path or len(ids) == IDS:
                    if ids:
                        yield path, words, ids[0], len(ids), ",".join(map(str, ids))
                    path, words, ids = p, w, []
                ids.append(c)
        if ids:
            yield path, words, ids[0], len(ids), ",".join(map(str, ids))

    return batches_of(rows(), schema)


def walk_shard(splitters: list[bytes]):
    """Finished nodes and parts of skeleton nodes, from rows (range, path, words, first, n, ids) sorted by range, path and first."""

    def run(batches):
        def rows():
            walk = Walk(splitters)
            for batch in batches:
                names = ("range", "path", "words", "first", "n", "ids")
                for place, path, words, first, n, ids in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                    node = walk.reach(place, path, words)
                    node.gains(n, first, 0, 0, 0)
                    if node.ends is None:
                        node.ends = hashlib.sha256()
                    else:
                        node.ends.update(b",")
                    node.ends.update(ids.encode())
                    yield from walk.take()
            walk.close(0)
            yield from walk.take()

        return batches_of(rows(), WALKED_SCHEMA)

    return run


def walk_skeleton(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The skeleton's nodes from the sums of their parts, sorted by prefix."""

    def rows():
        walk = Walk(None)
        names = ("prefix", "words", "n_convs", "conv_id", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
        for batch in batches:
            for path, words, n, least, children, leaves, saved, ends in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                node = walk.reach(0, path, [words])
                node.gains(n, least, children, leaves, saved)
                node.ends = ends
                yield from walk.take()
        walk.close(0)
        yield from walk.take()

    return batches_of(rows(), WALKED_SCHEMA)


def name_parents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a walk read backwards, so that parents come before their children, with the parent's smallest member.

    Parts of skeleton nodes pass as they are; children of skeleton nodes learn their parent later.
    """
    least: dict[int, int] = {}
    for batch in batches:
        depths, ids, waits = (batch.column(c).to_pylist() for c in ("depth", "conv_id", "waits"))
        parents = []
        for depth, conv_id, waiting in zip(depths, ids, waits, strict=True):
            parents.append(None if waiting else least.get(depth - 1))
            least[depth] = conv_id
        columns = [pa.array(parents, pa.int64()) if f.name == "parent_conv_id" else batch.column(f.name) for f in WALKED_SCHEMA]
        yield pa.RecordBatch.from_arrays(columns, schema=WALKED_SCHEMA)


def with_parents(walked: DataFrame, waits: Column) -> DataFrame:
    backwards = walked.withColumn("waits", waits).sortWithinPartitions(F.desc("seq"))
    return backwards.mapInArrow(name_parents, WALKED)


def choose_splitters(chunks: DataFrame) -> list[bytes]:
    """Paths, cut to what tells them from the one before, that part all paths into ranges of about RANGE_TURNS turns.

    There are MOST_RANGES ranges at most and SKELETON_TURNS turns in all splitters; what is drawn for a range is a fixed number.
    """
    weighed = chunks.select("path", (F.size("words") + 1).cast("long").alias("size"), F.xxhash64("path", "first").alias("tie"))
    total = weighed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    ranges = max(1, min(MOST_RANGES, total // RANGE_TURNS + 8))
    longest = SKELETON_TURNS // ranges * TURN
    if not total:
        return []
    sample = drawn(weighed, SAMPLED * ranges / total).select(F.expr(f"substring(path, 1, {longest})").alias("path"))
    tiled = sample.withColumn("tile", F.ntile(ranges).over(Window.orderBy("path")))
    paths = sorted({bytes(r["path"]) for r in tiled.groupBy("tile").agg(F.min("path").alias("path")).where("tile > 1").collect()} - {b""})
    return [path[: (shared_turns(before, path) + 1) * TURN] for before, path in zip([b"", *paths], paths)]


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for each distinct prefix of conversations (conv_id long, turns array of (key, words)).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): the smallest member, the number of
    turns, the parent's smallest member (null for the root), members, child nodes, childless nodes of the subtree, the words
    of all turns of the subtree that members beyond a node's first repeat, and the SHA-256 of the ids of the conversations that end
    here, ascending and joined by commas. Conversations without turns are members of the root alone. A conv_id has one row;
    equal conversations, however many, are grouped before they are walked, and only their ids are read one after the other.
    Null turns count as none. An empty table has no node, not even a root. Other columns are left out.
    """
    turns = F.coalesce("turns", F.array().cast("array<struct<key:string,words:int>>"))
    paths = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.unhex(F.array_join(F.transform(turns, lambda t: t["key"]), "")).alias("path"),
        F.transform(turns, lambda t: t["words"].cast("int")).alias("words"),
    )
    sorted_paths = paths.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    chunks = materialize(
        sorted_paths.mapInArrow(grouped_ids, "path binary, words array<int>, first long, n long, ids string")
    )
    splitters = choose_splitters(chunks)
    coded = [base64.b64encode(s).decode() for s in splitters]
    ranged = chunks.withColumn("range", rank_among(coded, "binary", F.col("path")))
    shards = ranged.repartition("range").sortWithinPartitions("range", "path", "first")
    walked = shards.select("range", "path", "words", "first", "n", "ids").mapInArrow(walk_shard(splitters), WALKED)
    nodes = materialize(with_parents(walked, F.col("prefix").isNotNull() | F.col("above").isNotNull()))

    parts = nodes.where("prefix IS NOT NULL").groupBy("prefix").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("words").alias("words"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends_sha256").alias("ends_sha256"),
    )
    skeleton = materialize(
        with_parents(parts.repartition(1).sortWithinPartitions("prefix").mapInArrow(walk_skeleton, WALKED), F.lit(False))
    )
    names = [part.split()[0] for part in SPREAD.split(", ")]
    above = F.broadcast(skeleton.select(F.unhex(F.md5("prefix")).alias("above"), F.col("conv_id").alias("skeleton_parent")))
    finished = nodes.where("prefix IS NULL").join(above, "above", "left")
    finished = finished.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "skeleton_parent"))
    return finished.select(*names).union(skeleton.select(*names))

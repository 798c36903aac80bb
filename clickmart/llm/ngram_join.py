"""Near copies by n-gram Jaccard similarity, found through adaptive multi-match prefixes.

Two sets with Jaccard similarity t or more share at least L of the first n - ceil(t * n) + L elements of
either, in any order of elements common to all. The order is by estimated document frequency, rare first, so a passage that
many documents share enters a prefix last. Each document picks its own L: the estimated cost of its candidates
decides how much the prefix is lengthened. A pair has to share as many prefix elements as its sizes leave no way around:
what is not shared there has to be among the elements behind one of the two prefixes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.llm.arrays import mix, pieces, shingles, words
from clickmart.llm.graph import components
from clickmart.llm.ids import numbered, row_key, whole
from clickmart.operators.materialize import materialize

SKETCH_BITS = 21
SLICES = 32
MOST_MATCHES = 4
VERIFY_COST = 0.05  # of one shingle of a candidate, against one row of the candidate search
CELL_WEIGHT = 8 << 20  # tokens, or bytes of text, in a block of classes that are compared with one another
CELL_CLASSES = 1000


def distinct_shingles(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, offsets = shingles(*words(column), k)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        yield np.unique(hashes[a:b])


def profile_texts(k: int):
    """Per text: size and two order-free hashes of its set. Per task: its share of the frequency sketch."""

    def run(batches):
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        waiting, size = [], 0
        for batch in batches:
            for piece in pieces(batch, "text"):
                sizes, first, second = [], [], []
                for own in distinct_shingles(piece.column("text"), k):
                    sizes.append(len(own))
                    first.append(np.add.reduce(mix(own ^ np.uint64(0x5BD1E995)), dtype=np.uint64))
                    second.append(np.add.reduce(mix(own + np.uint64(0x1B873593)), dtype=np.uint64))
                    waiting.append((own >> np.uint64(64 - SKETCH_BITS)).astype(np.int32))
                    size += len(own)
                    if size > 2_000_000:
                        counts += np.bincount(np.concatenate(waiting), minlength=len(counts)).astype(np.uint32)
                        waiting, size = [], 0
                n = piece.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("id"),
                        pa.array(sizes, pa.int64()),
                        pa.array(np.array(first, np.uint64).view(np.int64)),
                        pa.array(np.array(second, np.uint64).view(np.int64)),
                        pa.nulls(n, pa.int32()),
                        pa.nulls(n, pa.binary()),
                    ],
                    names=["id", "n", "first", "second", "part", "counts"],
                )
        if waiting:
            counts += np.bincount(np.concatenate(waiting), minlength=len(counts)).astype(np.uint32)
        if counts.any():
            parts = [zlib.compress(x.tobytes(), 1) for x in np.split(counts, SLICES)]
            none = pa.nulls(SLICES, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, none, none, pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())],
                names=["id", "n", "first", "second", "part", "counts"],
            )

    return run


def add_sketches(batches):
    """Sum of the shares that arrive, by part of the sketch; one running sum per part."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts"), strict=True):
            own = np.frombuffer(zlib.decompress(counts.as_py()), np.uint32)
            before = sums.get(part)
            sums[part] = own if before is None else np.minimum(before.astype(np.uint64) + own, 2**32 - 1).astype(np.uint32)
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([zlib.compress(x.tobytes(), 1) for x in sums.values()], pa.binary())],
            names=["part", "counts"],
        )


def frequency_sketch(profile: DataFrame) -> np.ndarray:
    """Estimated number of documents by the leading bits of a shingle's hash; of fixed size, over all documents."""
    shares = profile.where("part is not null").select("part", "counts")
    summed = shares.repartition("part").mapInArrow(add_sketches, "part int, counts binary")
    sketch = np.zeros((SLICES, (1 << SKETCH_BITS) // SLICES), np.uint32)
    for row in summed.collect():  # SLICES rows, 8 MB at any input size
        sketch[row.part] = np.frombuffer(zlib.decompress(row.counts), np.uint32)
    return sketch.ravel()


def least_shared(n, percent: int):
    """Fewest elements that a set of n shares with any similar set."""
    return -(-n * percent // 100)


def prefix_texts(k: int, percent: int, sketch):
    """Per text: its size, the number of matches it asks for, and its lengthened prefix."""

    def run(batches):
        counts = sketch.value
        noise = float(counts.mean())
        for batch in batches:
            for piece in pieces(batch, "text"):
                sizes, asked, prefixes = [], [], []
                for own in distinct_shingles(piece.column("text"), k):
                    n = len(own)
                    most = min(MOST_MATCHES, least_shared(n, percent))
                    seen = counts[(own >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                    order = np.lexsort((own, seen))[: n - least_shared(n, percent) + most]
                    matches = 1
                    if n:
                        rows = np.cumsum(np.maximum(seen[order] - noise - 3 * noise**0.5, 0))
                        lengths = n - least_shared(n, percent) + np.arange(1, most + 1)
                        reach = rows[lengths - 1]
                        cost = reach + reach / np.arange(1, most + 1) * VERIFY_COST * n
                        matches = int(cost.argmin()) + 1
                        order = order[: lengths[matches - 1]]
                    sizes.append(n)
                    asked.append(matches)
                    prefixes.append(own[order].view(np.int64))
                flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
                ends = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("id"),
                        pa.array(sizes, pa.int64()),
                        pa.array(asked, pa.int32()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    ],
                    names=["id", "n", "asked", "tokens"],
                )

    return run


def overlaps(own: list[np.ndarray]) -> np.ndarray:
    """Number of elements that any two of the sets share."""
    g = len(own)
    row = np.repeat(np.arange(g), [len(x) for x in own])
    _, ids, repeats = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
    shared = repeats[ids] > 1
    row, ids = row[shared], ids[shared]
    _, ids = np.unique(ids, return_inverse=True)
    order = np.argsort(ids, kind="stable")
    row, ids = row[order], ids[order]
    both = np.zeros((g, g), np.float32)
    width = max(1, min(4096, (8 << 20) // g))
    for low in range(0, int(ids[-1]) + 1 if len(ids) else 0, width):
        a, b = np.searchsorted(ids, [low, low + width])
        block = np.zeros((g, width), np.float32)
        block[row[a:b], ids[a:b] - low] = 1
        both += block @ block.T
    return np.rint(both).astype(np.int64)


def linked_blocks(own: list[np.ndarray], percent: int) -> np.ndarray:
    """Labels of sets that are linked, straight or through others: the place of the first one of each group."""
    labels = np.arange(len(own))
    sizes = np.array([len(x) for x in own])
    both = overlaps(own)
    linked = (100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)) & (sizes[:, None] > 0)
    while True:
        near = np.where(linked, labels[None, :], labels[:, None]).min(axis=1)
        near = near[near]
        if (near == labels).all():
            return labels
        labels = near


def grouped(batches, columns: list[str]) -> Iterator[tuple]:
    """(cell, one list for each column) for every run of rows with the same cell."""
    cell, kept = None, [[] for _ in columns]
    for batch in batches:
        for key, *values in zip(batch.column("cell").to_pylist(), *(batch.column(c).to_pylist() for c in columns), strict=True):
            if key != cell:
                if kept[0]:
                    yield cell, *kept
                cell, kept = key, [[] for _ in columns]
            for column, value in zip(kept, values, strict=True):
                column.append(value)
    if kept[0]:
        yield cell, *kept


def in_batches(rows: Iterator[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of long values, some thousand at a time."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*held, strict=True)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*held, strict=True)], names=names)


def promising(percent: int):
    """(home, node) of the classes that share enough prefix elements with another one of their cell."""

    def rows(batches):
        for cell, nodes, sizes, asked, tokens in grouped(batches, ["node", "n", "asked", "tokens"]):
            if len(nodes) < 2:
                continue
            n, most = np.array(sizes), np.array(asked)
            behind = least_shared(n, percent) - most
            needed = -(-percent * (n[:, None] + n[None, :]) // (100 + percent)) - np.maximum(behind[:, None], behind[None, :])
            alike = 100 * np.minimum(n[:, None], n[None, :]) >= percent * np.maximum(n[:, None], n[None, :])
            enough = alike & (overlaps([np.array(t, np.int64) for t in tokens]) >= needed)
            np.fill_diagonal(enough, False)
            for i in np.flatnonzero(enough.any(axis=1)).tolist():
                yield cell["home"], nodes[i]

    return lambda batches: in_batches(rows(batches), ["home", "node"])


def verify_cells(k: int, percent: int):
    """Edges of the documents in each cell; rows come sorted by cell, and one cell is held at a time."""

    def rows(batches):
        for _, nodes, texts in grouped(batches, ["node", "text"]):
            if len(nodes) < 2:
                continue
            own = list(distinct_shingles(pa.array(texts, pa.large_string()), k))
            for i, j in enumerate(linked_blocks(own, percent).tolist()):
                if nodes[i] != nodes[j]:
                    yield nodes[i], nodes[j]

    return lambda batches: in_batches(rows(batches), ["a", "b"])


def verify_pairs(k: int, percent: int):
    """Those pairs of texts that are similar enough."""

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text_a"):
                first = distinct_shingles(piece.column("text_a"), k)
                second = distinct_shingles(piece.column("text_b"), k)
                kept = []
                for x, y in zip(first, second, strict=True):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    kept.append(len(x) > 0 and 100 * both >= percent * (len(x) + len(y) - both))
                yield piece.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return run


def links(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Class of every document (id, n, node), and edges (a, b) between classes that keep all connections.

    Documents with the same set form a class, named by its smallest id. A class that shares a prefix element
    with others has as its home the smallest class that it shares one with. Two classes may only be similar if they share
    as many prefix elements as sets of their sizes have to. Within a home that is counted for all classes in
    blocks of bounded size, and those with a possible partner are compared on their whole sets in the same way; a block hands on
    a spanning forest only, never pairs. Classes of different homes that share enough are few and become pairs.
    """
    profile = materialize(
        docs.mapInArrow(profile_texts(k), "id long, n long, first long, second long, part int, counts binary")
    )
    sketch = docs.sparkSession.sparkContext.broadcast(frequency_sketch(profile))
    sized = profile.where("part is null").select("id", "n", "first", "second")
    # Written, so that the join below has a shuffle on either side and a hot class can be split there.
    groups = materialize(sized.where("n > 0").groupBy("first", "second", "n").agg(F.min("id").alias("node")))
    members = sized.join(groups, ["first", "second", "n"], "left").select("id", "n", "node")

    nodes = groups.select(F.col("node").alias("id")).where("id is not null").distinct()
    prefixes = materialize(
        docs.mapInArrow(prefix_texts(k, percent, sketch), "id long, n long, asked int, tokens array<long>")
        .where("n > 0")
        .join(nodes, "id", "left_semi")
    )
    postings = prefixes.select(F.explode("tokens").alias("token"), F.col("id").alias("node"))
    shared = postings.groupBy("token").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    shared = shared.where("least < most").select("token", "least")
    postings = materialize(postings.join(shared, "token"))
    # A class has no more tokens than its prefix.
    homes = postings.groupBy("node").agg(F.min("least").alias("home"), F.collect_set("token").alias("tokens"))
    homes = materialize(homes.join(prefixes.select(F.col("id").alias("node"), "n", "asked"), "node"))

    near = materialize(
        cells(homes.select("home", "node", "n", "asked", "tokens"), F.size("tokens"))
        .mapInArrow(promising(percent), "home long, node long")
        .distinct()
    )
    pairs = materialize(pairs_across(postings, homes, percent))
    wanted = near.select("node").union(pairs.select("a")).union(pairs.select("b")).distinct()
    texts = materialize(docs.join(wanted, F.col("id") == F.col("node")).select("node", "text"))
    found = cells(near.join(texts, "node"), F.octet_length("text")).mapInArrow(verify_cells(k, percent), "a long, b long")
    across = (
        pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        .mapInArrow(verify_pairs(k, percent), "a long, b long")
    )
    return members, found.union(across)


def pairs_across(postings: DataFrame, homes: DataFrame, percent: int) -> DataFrame:
    """(a, b): classes of different homes that share as many prefix elements as similar sets of their sizes have to."""
    placed = postings.select("token", "node").join(homes.select("node", "home", "n", "asked"), "node")
    mixed = placed.groupBy("token").agg(F.min("home").alias("low"), F.max("home").alias("high"))
    placed = materialize(placed.join(mixed.where("low < high").select("token"), "token"))
    # Elements that a similar pair shares, and those behind the shortest prefix of a set of n.
    needed = f"ceil({percent} * (a_n + b_n) / {100 + percent})"
    behind = f"ceil({percent} * {{}} / 100)".format
    a, b = placed.alias("a"), placed.alias("b")
    return (
        a.join(b, F.expr(
            "a.token = b.token and a.home < b.home and a.node <> b.node"
            f" and 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)"
        ))
        .groupBy(F.col("a.node").alias("a"), F.col("b.node").alias("b"))
        .agg(F.count("*").alias("both"), *[F.first(c).alias(c.replace(".", "_")) for c in ("a.n", "a.asked", "b.n", "b.asked")])
        .where(f"both >= {needed} - greatest({behind('a_n')} - a_asked, {behind('b_n')} - b_asked)")
        .select("a", "b")
    )


def cells(rows: DataFrame, weight: Column) -> DataFrame:
    """``rows`` (home, node, ..) sorted by ``cell``, once for each block pair of the home that a row belongs to.

    A home whose weight is more than CELL_WEIGHT is dealt into blocks by a hash of the class; any two classes of a
    home meet in one cell, which holds two blocks at most. Homes of one class have no cell.
    """
    blocks = rows.groupBy("home").agg(F.sum(weight.cast("long")).alias("weight"), F.count("*").alias("classes"))
    blocks = blocks.where("classes > 1").select(
        "home", F.greatest(F.ceil(F.col("weight") / F.lit(CELL_WEIGHT)), F.ceil(F.col("classes") / F.lit(CELL_CLASSES))).cast("int").alias("blocks")
    )
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = rows.join(blocks, "home").withColumn("own", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = F.struct("home", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    dealt = dealt.withColumn("cell", cell).drop("home", "own", "other", "blocks")
    return dealt.repartition("cell").sortWithinPartitions("cell", "node")


def ngram_jaccard(docs: DataFrame, k: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Groups of near copies: one row (doc_id, n_shingles, component_id) for every row of ``docs``.

    Words are runs without white space, A-Z lower-cased. A document's set holds its distinct runs of ``k`` words; a shorter text
    is one run; a null or empty text has no set and is linked with nothing. Two documents link where
    100 * |both| >= percent * |either|; ``component_id`` is the smallest id reachable by links.
    Sets are compared by 64-bit hashes of their runs. Rows that share an id count as one document. A null id links with nothing
    by itself: it gets the component of the documents with the same set, or null if there are none.
    Ids that are no whole numbers go by their own order and keep their type. Other columns of ``docs`` are not read, whatever
    their names. An empty table gives an empty result.
    """
    if not whole(docs, id_column):
        placed, ids = numbered(docs.select(id_column, F.col(text_column).alias("text")), id_column, "id")
        found = ngram_jaccard(placed, k, percent, "id", "text")
        for name in ("doc_id", "component_id"):
            found = found.withColumnRenamed(name, "id").join(ids, "id", "left").drop("id").withColumnRenamed("_id", name)
        return found.select("doc_id", "n_shingles", "component_id")
    narrow = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    members, edges = links(narrow, k, percent)
    labels = components(edges)
    return members.join(labels, "node", "left").select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "node", "id").alias("component_id"),
    )


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each group of near copies, and all rows without any word; all columns stay.

    Rows are told apart by a hash of id and text, so ids may be null or repeat: rows that share an id and not the text go by their
    texts. Of a group the row with the smallest id stays, null last, and of several with that id the one with the least hash; of
    rows that share id and text one stays, the least by all columns that can be compared.
    """
    key = row_key(id_column, text_column)
    keyed = docs.select(key.alias("key"), F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    groups = ngram_jaccard(keyed, k, percent, "key").where("n_shingles > 0")
    groups = groups.groupBy(F.col("doc_id").alias("key")).agg(F.min("component_id").alias("component"), F.count("*").alias("rows"))
    named = materialize(groups.join(keyed.groupBy("key").agg(F.min("id").alias("id")), "key"))
    first = named.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first"))
    judged = named.join(first.select("component", F.col("first.key").alias("stays")), "component")
    # Only keys with something to be done. Not written, so that Spark plans the join with the texts alike at every size.
    gone = judged.where("key <> stays OR rows > 1").select(F.col("key").alias("_key"))
    again = judged.where("key = stays AND rows > 1").select(F.col("key").alias("_key"))
    plain = docs.join(gone, key == gone["_key"], "left_anti")
    if again.isEmpty():
        return plain
    ordered = [f.name for f in docs.schema.fields if isinstance(f.dataType, T.AtomicType)]
    several = docs.join(again, key == again["_key"]).groupBy("_key").agg(F.min_by(F.struct(*docs.columns), F.struct(*[F.col(c) for c in ordered])).alias("_row"))
    return plain.unionByName(several.select("_row.*"))


"""Periodic runs, the prefix trie and shards: brute force, properties and odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickmart.llm import periodic_runs, prefix_trie, queries, sharding

NO_ENDS = hashlib.sha256(b"").hexdigest()
CLASH = ["id", "runs", "range", "key", "tie", "place", "shard", "slot", "path", "turns", "row", "size"]


def clashing(frame, leave=()):
    for name in CLASH:
        if name not in frame.columns and name not in leave:
            frame = frame.withColumn(name, F.lit("clash"))
    return frame


# ---- periodic runs


def all_runs(words):
    found = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(6, 4 * q):
                part = words[i : j + q]
                if not any(all(part[t] == part[t + p] for t in range(length - p)) for p in range(1, q)):
                    found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some_text(rng):
    kinds, n = rng.choice([1, 2, 2, 3, 5, 50]), rng.randint(0, 160)
    words = [f"w{rng.randrange(kinds)}" for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        if n > 4:
            a = rng.randrange(n)
            p, end = rng.randint(1, max(1, (n - a) // rng.randint(2, 6))), rng.randint(a, n)
            for i in range(a, end):
                words[i] = words[a + (i - a) % p]
    return words


@pytest.mark.parametrize("seed", range(120))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    texts = [some_text(rng) for _ in range(rng.randint(1, 6))]
    found = periodic_runs.runs_of_texts([" ".join(t).encode() for t in texts])
    for words, (n, runs, text) in zip(texts, found, strict=True):
        assert (n, runs) == (len(words), all_runs(words))
        assert text.decode() == collapsed(words, runs)


def test_range_successor():
    rng = np.random.default_rng(4)
    values = rng.permutation(700)
    tree = periodic_runs.WaveletMatrix(values)
    left = rng.integers(0, 600, 300)
    right = left + rng.integers(1, 100, 300)
    limit = rng.integers(0, 700, 300)
    below = tree.below(left, right, limit)
    assert below.tolist() == [int((values[a:b] < x).sum()) for a, b, x in zip(left, right, limit, strict=True)]
    place = rng.integers(0, right - left)
    assert tree.at_place(left, right, place).tolist() == [
        int(np.sort(values[a:b])[k]) for a, b, k in zip(left, right, place, strict=True)
    ]


def test_registered_runs_equal_brute_force(spark, tmp_path):
    rng = random.Random(11)
    texts = [(i, " \t\n"[i % 3].join(some_text(rng)) if i % 9 else ["", None, "  "][i % 3]) for i in range(400)]
    texts += [(None, "a " * 9), (500, "x y " * 3000), (501, " ".join(f"v{i}" for i in range(5000))), (502, "z" * 300_000), (7, "b " * 8)]
    clashing(spark.createDataFrame(texts, "doc_id long, text string")).write.parquet(f"{tmp_path}/documents.parquet")
    wanted = []
    for doc_id, text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if doc_id is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = all_runs(words) if n < 4000 else [(0, 6000, 2)] if doc_id == 500 else []
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        wanted.append(
            (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2])
            + (hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs).encode()).hexdigest())
        )
    assert sum(zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in texts) > 20
    assert all(zlib.crc32(str(d).encode()) % 10 for d in (500, 501)), "their words are taken as they are"
    assert sorted(map(tuple, queries.op11_periodic_runs(spark, str(tmp_path)).collect()), key=str) == sorted(wanted, key=str)


def test_runs_of_odd_rows(spark):
    rows = [("a", None), ("b", ""), ("c", " \n"), (None, "x " * 6), ("a", "x x x x x"), ("a", "x x x x x")]
    docs = clashing(spark.createDataFrame(rows, "doc_id string, text string"))
    found = periodic_runs.periodic_runs(docs)
    assert found.columns == ["doc_id", "n_words", "runs", "collapsed"]
    got = sorted(((r["doc_id"], r["n_words"], len(r["runs"]), r["collapsed"]) for r in found.collect()), key=str)
    assert got == sorted([("a", 0, 0, ""), ("b", 0, 0, ""), ("c", 0, 0, ""), (None, 6, 1, "x")] + [("a", 5, 0, "x x x x x")] * 2, key=str)
    assert periodic_runs.periodic_runs(docs.where("false")).collect() == []


# ---- prefix trie


def trie_of(conversations):
    """Node rows of {conv_id: [(role, text)]}."""
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def below(node):
        return [node] + [x for child in children[node] for x in below(child)]

    rows = []
    for node, ids in members.items():
        tree = below(node)
        saved = sum((len(members[x]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) for x in tree if x)
        ends = ",".join(map(str, sorted(c for c in ids if len(conversations[c]) == len(node))))
        rows.append(
            (min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(children[node]))
            + (sum(not children[x] for x in tree), saved, hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(rows, key=str)


def rebuilt(conversations):
    out = {}
    for c, turns in conversations.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = conversations.get(c - c % 20, [])[:h] + turns[h:]
    return out


def some_conversations(rng, n, deep=0):
    out = {}
    for c in rng.sample(range(3 * n), n):
        turns = [(rng.choice(["user", "bot", ""]), " ".join(rng.choices("ab", k=rng.randint(0, 2)))) for _ in range(rng.randint(1, 6))]
        if rng.random() < 0.3:  # one very common conversation
            turns = [("user", "hello there"), ("bot", "hi"), ("user", "bye")]
        if deep and rng.random() < 0.1:
            turns = [("user", "again and again")] * rng.randint(deep // 2, deep)
        out[c] = turns
    return out


def as_rows(conversations, rng):
    rows = [(c, i if i else None, r or None, t or None) for c, turns in conversations.items() for i, (r, t) in enumerate(turns)]
    rng.shuffle(rows)
    return rows


TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize(("seed", "n", "deep", "range_turns"), [(1, 40, 0, 50_000), (2, 300, 0, 40), (3, 250, 60, 100)])
def test_registered_trie_equals_brute_force(spark, tmp_path, monkeypatch, seed, n, deep, range_turns):
    monkeypatch.setattr(prefix_trie, "RANGE_TURNS", range_turns)
    monkeypatch.setattr(prefix_trie, "IDS", 7)
    rng = random.Random(seed)
    conversations = some_conversations(rng, n, deep)
    frame = spark.createDataFrame(as_rows(conversations, rng), TURNS).repartition(5)
    clashing(frame).write.parquet(f"{tmp_path}/conversations.parquet")
    found = sorted(map(tuple, queries.op12_prefix_trie(spark, str(tmp_path)).collect()), key=str)
    assert found == trie_of(rebuilt(conversations))


def test_skeleton_is_bounded_and_changes_nothing(spark, monkeypatch):
    rng = random.Random(8)
    conversations = some_conversations(rng, 400, 40)
    turns = prefix_trie.conversation_turns(spark.createDataFrame(as_rows(conversations, rng), TURNS))
    monkeypatch.setattr(prefix_trie, "RANGE_TURNS", 20)
    wanted = trie_of(conversations)
    for bound in (1 << 17, 200):
        monkeypatch.setattr(prefix_trie, "SKELETON_TURNS", bound)
        assert sorted(map(tuple, prefix_trie.prefix_trie(turns).collect()), key=str) == wanted


def test_trie_of_odd_rows(spark):
    turns = [(1, None, None, None), (1, 0, "user", "x y"), (2, 5, "", ""), (2, 7, "user", "x y"), (2, 7, "user", "x y"), (None, 0, "user", "q")]
    nodes = prefix_trie.prefix_trie(prefix_trie.conversation_turns(clashing(spark.createDataFrame(turns, TURNS))))
    same, said = ("", ""), ("user", "x y")
    assert sorted(map(tuple, nodes.collect()), key=str) == trie_of({1: [same, said], 2: [same, said, said]})
    empty = prefix_trie.conversation_turns(spark.createDataFrame([], TURNS))
    assert prefix_trie.prefix_trie(empty).collect() == []
    bare = spark.createDataFrame([(3, []), (9, None)], "conv_id long, turns array<struct<key:string,words:int>>")
    digest = hashlib.sha256(b"3,9").hexdigest()
    assert [tuple(r) for r in prefix_trie.prefix_trie(bare).collect()] == [(3, 0, None, 2, 0, 1, 0, digest)]


# ---- sharding


def placed(frame, key="k", **more):
    within = more.pop("within", F.md5(F.col("i").cast("string")))
    return sharding.shard(frame, more.pop("shards", 10), F.col(key), F.col("size"), within, **more)


def shard_sums(rows):
    sums, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        sums[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sums


@pytest.mark.parametrize("ranges", [1, 16, 512])
def test_shards_are_even_whatever_the_sample(spark, ranges):
    rng = random.Random(5)
    rows = [(i, "hot" if i % 3 == 0 else f"k{rng.randrange(900)}", rng.choice([1, 10, 10, 50, 400])) for i in range(6000)]
    frame = spark.createDataFrame(rows, "i long, k string, size long").repartition(7)
    got = placed(frame, ranges=ranges).collect()
    sums = shard_sums(got)
    mean = sum(r[2] for r in rows) / 10
    assert len(got) == 6000 and set(sums) == set(range(10))
    assert all(abs(s - mean) <= max(400, 0.05 * mean) for s in sums.values())
    homes = defaultdict(set)
    for r in got:
        homes[r["k"]].add(r["shard"])
    sizes = defaultdict(int)
    for _, k, size in rows:
        sizes[k] += size
    assert all(len(homes[k]) == 1 for k in homes if sizes[k] <= 0.05 * mean) and len(homes["hot"]) > 2
    order = sorted(rows, key=lambda r: (r[1], hashlib.md5(str(r[0]).encode()).hexdigest()))
    assert [r["i"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))] == [r[0] for r in order]


def test_overfull_ranges_are_parted(spark):
    frame = spark.range(4000).selectExpr("id AS i", "IF(id < 3600, 'one', concat('k', id)) AS k", "10 AS size")
    records = frame.select(
        F.struct("i").alias("row"), F.col("k").alias("key"), F.md5(F.col("i").cast("string")).alias("within"),
        F.col("i").alias("tie"), F.col("size").cast("long").alias("size"),
    )
    first = sharding.first_splitters(records, 40_000, 50)
    before = sharding.sizes(records, first)
    more = sharding.more_splitters(records, first, before, 800)
    after = sharding.sizes(records, sorted(first + more, key=lambda s: (s["key"], s["within"], s["tie"])))
    assert max(before)[0] >= 36_000 and max(after)[0] <= 3 * 800


def test_shards_of_odd_rows(spark):
    rows = [(None, None, None), (1, None, -5), (1, "", 0), (2, "b", 30), (2, "b", 30), (2, "b", 30), (3, "c", 1 << 40)]
    frame = clashing(spark.createDataFrame(rows, "i long, k string, size long"), leave=("size",))
    got = placed(frame, shards=4, within=F.col("i"))
    assert set(got.columns) == set(frame.columns)
    values = [r.asDict() for r in got.collect()]
    assert sorted(((r["i"], r["k"], r["size"]) for r in values), key=str) == sorted(rows, key=str)
    assert all(r["place"] == r["range"] == "clash" for r in values)
    assert {tuple(r.values()) for r in values if r["i"] == 3} and {r["shard"] for r in values if r["i"] == 3} == {2}
    nothing = placed(frame.withColumn("size", F.lit(0)), shards=4, within=F.col("i")).collect()
    assert len(nothing) == 7 and {r["shard"] for r in nothing} == {0}
    assert placed(frame.where("false")).collect() == []


def test_written_shards_read_back(spark, tmp_path):
    frame = spark.range(500).selectExpr("id AS i", "concat('k', id % 40) AS k", "1 + id % 7 AS size")
    got = placed(frame)
    sharding.write_shards(got, f"{tmp_path}/shards")
    back = spark.read.parquet(f"{tmp_path}/shards")
    key = lambda r: (r["shard"], r["slot"])
    plain = lambda df: [(r["i"], r["k"], r["size"], *key(r)) for r in sorted(df.collect(), key=key)]
    assert plain(back) == plain(got)


def test_sharding_stays_in_the_jvm(spark, data):
    plan = queries.op13_sharding(spark, data)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|ExistingRDD", plan)

from __future__ import annotations

import math
import random
from collections import defaultdict
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from clickmart.operators import blocks
from clickmart.plans import recommend, similarity

FIELDS = "user_id string, product_id string, interaction_type string, interaction_strength int"


def visits(spark, *data):
    df = spark.createDataFrame(list(data), FIELDS)
    return df.withColumn("interaction_time", F.lit("2024-01-01").cast("timestamp"))


def brute_similar(data, k, mode="vector"):
    weight, squares = defaultdict(lambda: defaultdict(int)), defaultdict(int)
    for user, product, _, s in data:
        weight[user][product] += s
        squares[user] += s * s
    norm = {
        u: squares[u] if mode == "rows" else sum(w * w for w in weight[u].values()) for u in weight
    }
    out = []
    for u in weight:
        ranked = []
        for v in weight:
            if u != v:
                dot = sum(w * weight[v].get(p, 0) for p, w in weight[u].items())
                ranked.append((-(dot * dot / norm[v]), v, dot / math.sqrt(norm[u] * norm[v])))
        for place, (_, v, score) in enumerate(sorted(ranked)[:k], start=1):
            out.append((u, v, round(score, 4), place))
    return sorted(out)


def skewed(seed, users=60, products=25, n=500):
    """A third of all interactions on one product, many users knowing nothing else."""
    draw = random.Random(seed)
    kinds = {"view": 1, "cart": 2, "purchase": 3}
    data = []
    for i in range(n):
        kind = draw.choice(list(kinds))
        product = "p00" if draw.random() < 0.34 else f"p{draw.randrange(1, products):02d}"
        data.append((f"u{draw.randrange(users):02d}", product, kind, kinds[kind]))
    for i in range(20):
        data.append((f"solo{i:02d}", "p00", "view", 1))
    return data


def compare(df, expected):
    actual = sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0], r[3]))
    expected = sorted(expected, key=lambda r: (r[0], r[3]))
    assert [(r[0], r[1], r[3]) for r in actual] == [(r[0], r[1], r[3]) for r in expected]
    for a, e in zip(actual, expected, strict=True):
        assert a[2] == pytest.approx(e[2], abs=1e-4)


@pytest.mark.parametrize("block", [1000, 12, 3])
@pytest.mark.parametrize("mode", ["vector", "rows"])
def test_similar_users_equal_brute_force(spark, block, mode, monkeypatch):
    monkeypatch.setattr(similarity, "SEEDS", 1)
    data = skewed(3)
    found = similarity.similar_users(visits(spark, *data), 5, mode, block=block)
    compare(found, brute_similar(data, 5, mode))


@pytest.mark.parametrize("block", [1000, 4])
@pytest.mark.parametrize("mode", ["vector", "rows"])
def test_copies_count_as_one(spark, block, mode, monkeypatch):
    draw = random.Random(11)
    data = [(f"u{draw.randrange(25):02d}", f"p{draw.randrange(9)}", "view", 1) for _ in range(120)]
    # A third of all users with the same two products, some of them twice as keen.
    for i in range(14):
        data += [(f"copy{i:02d}", "p1", "cart", 2), (f"copy{i:02d}", "p2", "purchase", 3)] * (
            1 + (i % 5 == 0)
        )
    rounds = []
    bounded = similarity._bounded
    monkeypatch.setattr(similarity, "SEEDS", 1)
    monkeypatch.setattr(
        similarity, "_bounded", lambda *args: rounds.append(args[-1]) or bounded(*args)
    )
    found = similarity.similar_users(visits(spark, *data), 6, mode, block=block)
    compare(found, brute_similar(data, 6, mode))
    assert (len(rounds) > 0) == (block == 4)


@pytest.mark.parametrize("block", [1000, 4])
def test_similar_users_of_targets(spark, block, monkeypatch):
    monkeypatch.setattr(similarity, "SEEDS", 1)
    data = skewed(5, users=30, n=200)
    targets = spark.createDataFrame([("u03",), ("solo07",), ("nobody",)], "user_id string")
    found = similarity.similar_users(visits(spark, *data), 4, targets=targets, block=block)
    expected = [r for r in brute_similar(data, 4) if r[0] in ("u03", "solo07")]
    compare(found, expected)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_bounds_lose_nobody(spark, seed, monkeypatch):
    """Several long lists a user, tastes of many strengths, some users with nothing but long lists."""
    monkeypatch.setattr(similarity, "SEEDS", 1)
    draw = random.Random(seed)
    data = []
    for user in range(70):
        for product in draw.sample(range(6), draw.randint(1, 4)):
            data += [(f"u{user:02d}", f"hot{product}", "purchase", 3)] * draw.choice([1, 1, 2, 5, 9])
        for product in draw.sample(range(40), draw.choice([0, 2, 5])):
            data += [(f"u{user:02d}", f"p{product:02d}", "cart", 2)] * draw.choice([1, 3])
    found = similarity.similar_users(visits(spark, *data), 3, block=4)
    compare(found, brute_similar(data, 3))


def test_a_crowded_product_does_not_make_all_pairs(spark, monkeypatch):
    users = 20_000
    made = []
    single, sums = similarity._single, similarity._sum_dots
    monkeypatch.setattr(similarity, "_single", lambda met: made.append(met) or single(met))
    monkeypatch.setattr(similarity, "_sum_dots", lambda met: made.append(met) or sums(met))
    everybody = spark.range(users).selectExpr("concat('u', id) AS user_id", "explode(array('hot', concat('a', id % 4000), concat('b', id * 7919 % 4001))) AS product_id", "id")
    data = everybody.selectExpr("user_id", "product_id", "'view' AS interaction_type", "1 + int(product_id = 'hot' AND id % 3 = 0) AS interaction_strength", "timestamp'2024-01-01' AS interaction_time")
    found = similarity.similar_users(data, 5)
    assert found.count() == 5 * users
    assert sum(met.count() for met in made) < users * users / 100


def test_strangers_fill_the_list(spark):
    data = [("a", "p", "view", 1), ("b", "q", "view", 1), ("c", "p", "view", 1)]
    found = similarity.similar_users(visits(spark, *data), 5)
    assert rows(found.where("user_id = 'b'").select("similar_user_id", "similarity_score")) == [
        ("a", 0.0),
        ("c", 0.0),
    ]
    assert rows(found.where("user_id = 'c'").select("similar_user_id", "similarity_score")) == [
        ("a", 1.0),
        ("b", 0.0),
    ]


def test_row_similarity_can_exceed_one(spark):
    data = [("a", "p", "view", 1)] * 2 + [("b", "p", "view", 1)] * 2
    pairs = spark.createDataFrame([("a", "b"), ("a", "z")], "user_1 string, user_2 string")
    by_rows = similarity.user_similarity(visits(spark, *data), pairs, "rows")
    assert rows(by_rows) == [("a", "b", 2.0), ("a", "z", 0.0)]
    cosine = similarity.user_similarity(visits(spark, *data), pairs, "vector")
    assert rows(cosine) == [("a", "b", 1.0), ("a", "z", 0.0)]
    with pytest.raises(ValueError):
        similarity.user_similarity(visits(spark, *data), pairs, "other")


def test_interactions_are_unique(spark):
    events = spark.createDataFrame(
        [("u", "p", "view"), ("u", "p", "view"), ("u", "p", "signup"), (None, "p", "view")],
        "user_id string, product_id string, event_type string",
    ).withColumn("event_time", F.lit("2024-01-01").cast("timestamp"))
    found = similarity.interactions_from_events(events)
    assert rows(found.select("interaction_type", "interaction_strength")) == [("view", 1)]


def test_collaborative(spark):
    data = [
        ("a", "p", "view", 1),
        ("b", "p", "view", 1),
        ("b", "q", "purchase", 3),
        ("c", "r", "view", 1),
    ]
    df = visits(spark, *data)
    unseen = recommend.collaborative(df, 5, 1).where("user_id = 'a'")
    similar = round(1 / math.sqrt(10), 4)
    assert [(r.product_id, r.recommendation_score) for r in unseen.collect()] == [
        ("q", pytest.approx(round(3 * similar, 4)))
    ]
    every = recommend.collaborative(df, 5, 1, exclude_seen=False).where("user_id = 'a'")
    assert [r.product_id for r in every.orderBy("rank").collect()] == ["q", "p"]


@pytest.mark.parametrize("limits", [None, (300, 40, 90), (50, 1, 1000)])
def test_collaborative_equals_brute_force(spark, limits, monkeypatch):
    """Only the best of a user leave the tasks, however many groups, blocks and parts there are; absent products and users count as before."""
    if limits:
        for name, value in zip(["GROUP_ENTRIES", "BLOCK_ENTRIES", "PARTNER_ENTRIES"], limits, strict=True):
            monkeypatch.setattr(blocks, name, value)
    made = []
    top = recommend.top_n
    monkeypatch.setattr(recommend, "top_n", lambda df, *args: made.append(df) or top(df, *args))
    draw = random.Random(8)
    kinds = ["view", "cart", "purchase"]
    data = []
    for _ in range(700):
        kind = draw.randrange(3)
        product = None if draw.random() < 0.03 else f"p{draw.randrange(40):02d}"
        data.append((f"u{draw.randrange(40):02d}", product, kinds[kind], kind + 1))
    near = [(f"u{u:02d}" if u < 45 else None, f"u{o:02d}", draw.choice([0.0, 0.25, 0.3333, 1.5])) for u in range(46) for o in draw.sample(range(48), 6)]
    near.append(("u01", None, 1.0))
    neighborhood = spark.createDataFrame(near, "user_id string, similar_user_id string, similarity_score double")
    liked = {}
    for user, product, _, strength in data:
        total, n = liked.get((user, product), (0, 0))
        liked[user, product] = total + strength, n + 1
    for exclude_seen in (True, False):
        sums = {}
        for user, other, units in ((u, o, round(s * 10000)) for u, o, s in near):
            for (who, product), (strength, n) in liked.items():
                if who == other:
                    total, rows_of = sums.get((user, product), (0, 0))
                    sums[user, product] = total + units * strength, rows_of + n
        expected = {}
        for (user, product), (total, n) in sums.items():
            if not exclude_seen or product is None or user is None or (user, product) not in liked:
                expected.setdefault(user, []).append((-math.floor((2 * total + n) / (2 * n)), product or "", product))
        expected = {(u, i + 1, p, -s / 10000) for u, found in expected.items() for i, (s, _, p) in enumerate(sorted(found)[:7])}
        found = recommend.collaborative(visits(spark, *data), 7, exclude_seen=exclude_seen, neighborhood=neighborhood)
        assert {(r["user_id"], r["rank"], r["product_id"], r["recommendation_score"]) for r in found.collect()} == expected
        parts = -(-len(liked) // limits[2]) if limits else 1
        assert made.pop().count() <= 46 * 7 * parts < len(sums) * (3 if parts > 1 else 1)


def test_collaborative_of_nobody(spark):
    nobody = visits(spark, ("a", "p", "view", 1)).where("user_id = 'b'")
    assert recommend.collaborative(nobody).collect() == []
    alone = visits(spark, ("a", "p", "view", 1))
    assert recommend.collaborative(alone, exclude_seen=False).collect() == []


def test_content_and_hybrid(spark):
    products = spark.createDataFrame(
        [
            ("p1", "b1", "c1", 5.0, 0.5),
            ("p2", "b1", "c2", 4.0, 0.5),
            ("p3", "b2", "c1", None, 0.9),
            ("p4", "b2", "c2", 5.0, 1.0),
        ],
        "product_id string, brand string, category_code string, avg_rating double, "
        "popularity_score double",
    )
    features = spark.createDataFrame(
        [("u1", "c1", "b1"), ("u2", None, None), ("u3", None, "b2")],
        "user_id string, favorite_category string, favorite_brand string",
    )
    content = recommend.content_based(features, products, 10)
    found = [(r.user_id, r.product_id, r.recommendation_score, r.rank) for r in content.collect()]
    assert sorted(found, key=lambda r: (r[0], r[3])) == [
        ("u1", "p1", 2.3, 1),
        ("u1", "p2", 1.9, 2),
        ("u1", "p3", None, 3),
        ("u3", "p4", 2.6, 1),
        ("u3", "p3", None, 2),
    ]
    assert recommend.content_based(features, products, 1).count() == 2
    collab = spark.createDataFrame(
        [("u1", "p2", 2.0), ("u1", "p9", 9.0)],
        "user_id string, product_id string, recommendation_score double",
    )
    mixed = recommend.hybrid(content.where("user_id = 'u1'"), collab, 10).orderBy("rank")
    assert [(r.product_id, r.recommendation_score) for r in mixed.collect()] == [
        ("p2", 1.97),
        ("p1", 0.69),
        ("p3", None),
    ]
    weights = recommend.hybrid(content, collab, 10, Decimal("1"), Decimal("0"))
    assert weights.where("product_id = 'p2'").first().recommendation_score == 1.9


@pytest.mark.parametrize("parts", [1, 4, 30])
def test_popularity_equals_brute_force(spark, parts):
    draw = random.Random(1)
    products = [(f"p{i:02d}", draw.choice([0.1, 0.2, 0.9, None])) for i in range(30)]
    order = sorted(products, key=lambda p: (p[1] is None, -(p[1] or 0), p[0]))
    data = [(f"u{draw.randrange(9)}", f"p{draw.randrange(30):02d}", "view", 1) for _ in range(120)]
    # Somebody who knows all but two products, among them all popular ones.
    data += [("expert", p, "view", 1) for p, _ in order[:28]]
    users = [f"u{i}" for i in range(9)] + ["expert", "newcomer"]
    expected = []
    for u in users:
        known = {p for who, p, _, _ in data if who == u}
        free = [p for p, _ in order if p not in known][:5]
        expected += [(u, p, i) for i, p in enumerate(free, start=1)]
    found = recommend.popularity_recs(
        spark.createDataFrame([(u,) for u in users], "user_id string"),
        spark.createDataFrame(products, "product_id string, popularity_score double").repartition(parts),
        visits(spark, *data),
    )
    assert rows(found.select("user_id", "product_id", "rank_position")) == sorted(expected)


def test_jitter_is_seeded_and_bounded(spark):
    products = spark.createDataFrame(
        [(f"p{i}", 0.5) for i in range(20)], "product_id string, popularity_score double"
    )
    users = spark.createDataFrame([("u",)], "user_id string")
    none = visits(spark, ("x", "y", "view", 1)).limit(0)

    def run(seed):
        return rows(recommend.popularity_recs(users, products, none, 20, 0.2, seed))

    assert run(1) == run(1) and run(1) != run(2)
    assert all(0.4 <= r[3] <= 0.6 for r in run(1)) and len({r[3] for r in run(1)}) > 1


def test_summaries_keep_users_and_products_without_recommendations(spark):
    features = spark.createDataFrame(
        [("u1", "c", "b"), ("u2", None, None)],
        "user_id string, favorite_category string, favorite_brand string",
    )
    recs = spark.createDataFrame(
        [("u1", "p1", 0.5, True, False), ("u1", "p2", 0.7, None, True)],
        "user_id string, product_id string, recommendation_score double, is_clicked boolean, "
        "is_purchased boolean",
    )
    summary = {r.user_id: r for r in recommend.recommendation_summary(features, recs).collect()}
    assert summary["u1"].avg_recommendation_score == pytest.approx(0.6)
    assert (summary["u1"].clicked_recommendations, summary["u2"].total_recommendations) == (1, 0)
    products = spark.createDataFrame(
        [("p1", 4.0, 0.1), ("p2", 4.0, 0.1), ("p3", 1.0, 0.1)],
        "product_id string, avg_rating double, popularity_score double",
    ).select("*", F.lit("b").alias("brand"), F.lit("c").alias("category_code"))
    performance = {
        r.product_id: r for r in recommend.recommendation_performance(products, recs).collect()
    }
    assert performance["p2"].conversion_rate == 100.0
    assert performance["p3"].times_recommended == 0 and performance["p3"].conversion_rate == 0.0


def test_no_task_has_a_popular_product_to_itself(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK_USERS", 50)
    users = spark.range(2000).select(F.col("id").alias("uid"), F.lit("hot").alias("product_id"), (F.col("id") % 7 + 1).alias("weight"), F.lit(9).alias("norm"))
    met = similarity._meet_in_blocks(users, similarity._others(users.where("uid < 10")), ["product_id"]).withColumn("task", F.spark_partition_id())
    assert met.count() == 20_000
    assert met.groupBy("task").count().agg(F.max("count")).first()[0] < 20_000


def test_pairs_of_users_are_no_rows(spark, monkeypatch):
    """Blocks meet, not users; a block of few users makes several groups and several blocks on the other side."""
    made = []
    single, sums = similarity._single, similarity._sum_dots
    monkeypatch.setattr(similarity, "_single", lambda met: made.append(met) or single(met))
    monkeypatch.setattr(similarity, "_sum_dots", lambda met: made.append(met) or sums(met))
    draw = random.Random(4)
    data = [(f"u{u:03d}", f"p{draw.randrange(30):02d}", "view", draw.randint(1, 4)) for u in range(300) for _ in range(5)]
    for block in (1000, 20):
        compare(similarity.similar_users(visits(spark, *data), 4, block=block), brute_similar(data, 4))
    assert 0 < sum(met.count() for met in made) < 300


def test_events_are_exchanged_once(spark):
    """Interactions are dealt by user, and what is added up by user and product needs no further exchange."""
    events = spark.range(100).selectExpr("concat('u', id % 7) AS user_id", "concat('p', id % 5) AS product_id", "'view' AS event_type", "timestamp'2024-01-01' AS event_time")
    vectors = similarity.user_vectors(similarity.interactions_from_events(events))
    plan = vectors._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert rows(vectors.agg(F.sum("weight"), F.sum("interactions"))) == [(35, 35)]


def test_entries_of_a_user_are_exchanged_as_one_row(spark):
    everybody = spark.range(3000).selectExpr("id + 1 AS place", "id * 7 AS uid", "id + 5 AS norm", "explode(sequence(id % 3, id % 3 + 9)) AS column", "10 - 40 * (id % 100) AS weight")
    assert everybody.mapInArrow(blocks._pieces, blocks.PIECES).count() < 3100
    packed, mixed = (sorted(map(tuple, blocks.pack(df).collect())) for df in (everybody, everybody.repartition(5, "column", "uid")))
    assert packed == mixed and [p[0] for p in packed] == [0, 1]
    first = blocks.Block([dict(zip(blocks._PAYLOAD, packed[0][1:], strict=True))])
    assert first.uids[:3].tolist() == [0, 7, 14] and first.norms[:3].tolist() == [5, 6, 7]
    assert first.columns[10:20].tolist() == list(range(1, 11)) and first.weights[[0, 10, 20 * 10]].tolist() == [10, -30, -790]


def test_vectors_do_not_travel_with_joins(spark, monkeypatch):
    """Places are the side that is copied; entries stay in the order in which users pack well."""
    made = []
    pack = similarity.pack
    monkeypatch.setattr(similarity, "pack", lambda df: made.append(df) or pack(df))
    draw = random.Random(8)
    data = [(f"u{u:03d}", f"p{p:02d}", "view", draw.randint(1, 4)) for u in range(500) for p in draw.sample(range(30), 8)]
    compare(similarity.similar_users(visits(spark, *data), 2), brute_similar(data, 2))
    entries = made[0].select("place", "uid", "norm", "column", "weight")
    assert entries.mapInArrow(blocks._pieces, blocks.PIECES).count() < 600


def packed(vectors):
    """``uid``, ``norm``, columns and weights of vectors as a block."""
    columns, weights = (np.concatenate([v[i] for v in vectors]) for i in (2, 3))
    steps = np.concatenate([np.diff(v[2], prepend=0) for v in vectors])
    assert (blocks._thick(blocks._thin(steps), len(columns)) == steps).all()
    of_vectors = np.array([v[0] for v in vectors]).tobytes(), blocks._narrow(np.array([v[1] for v in vectors])), blocks._narrow(np.array([len(v[2]) for v in vectors]))
    return dict(zip(blocks._PAYLOAD, map(blocks._press, [*of_vectors, blocks._thin(steps), blocks._narrow(weights)]), strict=True))


@pytest.mark.parametrize("strong", [3, 100_000_000])
def test_a_lane_keeps_the_best_partners(strong, monkeypatch):
    """Few products at once, ties in and between blocks, and dot products that fit no key."""
    monkeypatch.setattr(blocks, "WIDE_CELLS", 7)
    draw = np.random.default_rng(6)
    vectors = []
    for uid in range(90):
        columns = np.sort(draw.choice(70_000 if uid % 9 == 8 else 30, draw.integers(1, 6), replace=False))
        weights = draw.integers(1, 3, len(columns)) * (strong if strong < 9 or uid % 2 else 1)
        vectors.append((uid * 10, int((weights * weights).sum()), columns, weights))
    lane = blocks.Lane([packed(vectors[a : a + 15]) for a in (15, 45)], 3)
    for a in range(0, 90, 10):
        lane.meet(*blocks.unpack(packed(vectors[a : a + 10])))
    found = {}
    for batch in lane.rows():
        for row in batch.to_pylist():
            found.setdefault(row["uid"], []).append((row["other"], row["dot"], row["norm"], row["other_norm"]))
    for uid, norm, columns, weights in vectors[15:30] + vectors[45:60]:
        mine = dict(zip(columns.tolist(), weights.tolist(), strict=True))
        best = []
        for other, other_norm, theirs, with_weights in vectors:
            dot = sum(mine.get(c, 0) * w for c, w in zip(theirs.tolist(), with_weights.tolist(), strict=True))
            if other != uid and dot:
                best.append((-(float(dot) ** 2 / other_norm), other, dot, norm, other_norm))
        assert found.get(uid, []) == [b[1:] for b in sorted(best)[:3]]


def test_blocks_pass_each_lane_once(spark, monkeypatch):
    """Rows with a block do not carry those of the lane along, and there is no product of partitions."""
    monkeypatch.setattr(similarity, "LANE_WORK", 300)
    made = []
    single = similarity._single
    monkeypatch.setattr(similarity, "_single", lambda met: made.append(met) or single(met))
    draw = random.Random(9)
    data = [(f"u{u:03d}", f"p{draw.randrange(60):02d}", "view", draw.randint(1, 2)) for u in range(200) for _ in range(4)]
    found = similarity.similar_users(visits(spark, *data), 6)
    compare(found, brute_similar(data, 6))
    met = made[0].withColumn("lane", F.spark_partition_id())
    passing = met.where("side = 1").groupBy("block").agg(F.count("*").alias("times"), F.count_distinct("lane").alias("lanes"))
    lanes = made[0].rdd.getNumPartitions()
    assert lanes > 1 and passing.where(f"times <> {lanes} OR lanes <> {lanes}").count() == 0
    assert met.where("side = 0").count() == passing.count()
    assert "CartesianProduct" not in found._jdf.queryExecution().executedPlan().toString()
    targets = spark.createDataFrame([(f"u{u:03d}",) for u in range(0, 200, 2)], "user_id string")
    asked = similarity.similar_users(visits(spark, *data), 6, targets=targets)
    compare(asked, [r for r in brute_similar(data, 6) if int(r[0][1:]) % 2 == 0])


@pytest.mark.parametrize("strong", [3, 1_000_000_000_000])
@pytest.mark.parametrize("exclude_own", [True, False])
def test_what_neighbours_have_is_added_up_by_parts(strong, exclude_own, monkeypatch):
    """Added up before a part is complete, ties between parts, sums that fit no key, targets and neighbours that nobody is."""
    monkeypatch.setattr(blocks, "GROUP_ENTRIES", 20)
    draw = random.Random(12)
    has = {(f"u{u}", c): (draw.randint(1, 2) * strong, draw.randint(1, 2)) for u in range(20) for c in draw.sample(range(14), 6)}
    near = [(t, f"u{o}", draw.randint(1, 3)) for t in [None, "x", *(f"u{u}" for u in range(12))] for o in draw.sample(range(24), 5)]
    parts, half = 3, len(near) // 2
    lists = [tuple(zip(*some, strict=True)) for some in (near[:half], near[half:])]
    sums = blocks.Sums([pa.array(x[0], pa.string()) for x in lists], [pa.array(x[1], pa.string()) for x in lists], [np.array(x[2]) for x in lists], 4, exclude_own, parts)
    rows_of = [pa.table({"block": [b] * len(some), "user": [u for u, _ in some], "column": [c for _, c in some], "weight": [has[e][0] for e in some], "rows": [has[e][1] for e in some]}) for b in (0, 1) if (some := [e for e in has if int(e[0][1:]) % 2 == b])]
    blocks_of = [row for table in rows_of for row in blocks._pack_users(table, parts).to_pylist()]
    users = {}
    for row in sorted(blocks_of, key=lambda r: (r["part"], r["block"])):
        if row["part"] < 0:
            users[row["block"]] = row["users"]
            sums.know(row["block"], pa.array(row["users"]))
            continue
        sums.add(row["part"], row["block"], *blocks._parts_of(len(users[row["block"]]), *(row[name] for name in ("sizes", "columns", "weights", "counts"))))
    found = {}
    for batch in sums.rows():
        for row in batch.to_pylist():
            found.setdefault(row["target"], []).append((-row["score"], row["column"]))
    expected = {}
    for target in {t for t, _, _ in near}:
        total, rows_there = defaultdict(int), defaultdict(int)
        for _, other, units in (pair for pair in near if pair[0] == target):
            for column in range(14):
                weight, n = has.get((other, column), (0, 0))
                total[column] += units * weight
                rows_there[column] += n
        own = {c for c in range(1, 14) if (target, c) in has} if exclude_own else set()
        expected[target] = sorted((-((2 * total[c] + n) // (2 * n)), c) for c, n in rows_there.items() if n and c not in own)[:4]
    assert found == expected


def test_what_users_have_passes_each_lane_once(spark, monkeypatch):
    """Users of a block are named once, rows do not carry the pairs of a lane along, and there is no product of partitions."""
    for name, value in zip(["GROUP_ENTRIES", "BLOCK_ENTRIES", "PARTNER_ENTRIES"], (300, 200, 1500), strict=True):
        monkeypatch.setattr(blocks, name, value)
    made = []
    lanes_of = blocks.in_lanes
    monkeypatch.setattr(blocks, "in_lanes", lambda *args: made.append(lanes_of(*args)) or made[-1])
    draw = random.Random(3)
    data = [(f"u{draw.randrange(50):02d}", f"p{draw.randrange(40):02d}", "view", 1) for _ in range(600)]
    near = [(f"u{u:02d}", f"u{o:02d}", 0.5) for u in range(50) for o in draw.sample(range(50), 5)]
    neighborhood = spark.createDataFrame(near, "user_id string, similar_user_id string, similarity_score double")
    found = recommend.collaborative(visits(spark, *data), 3, neighborhood=neighborhood)
    assert "CartesianProduct" not in found._jdf.queryExecution().executedPlan().toString()
    met, lanes = made[0], made[0].rdd.getNumPartitions()
    assert lanes > 1 and met.where("side = 0").agg(F.sum(F.size("targets"))).first()[0] == len(near)
    assert met.where("side = 1").agg(F.sum(F.size("users"))).first()[0] == 50 * lanes
    assert met.where("side = 1 AND part >= 0 AND (users IS NOT NULL OR targets IS NOT NULL)").count() == 0

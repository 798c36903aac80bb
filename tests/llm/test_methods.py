"""Every operator against brute force, an exact round trip, held-out accuracy or its SQL twin."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import connect, differences
from clickmart.llm import (
    arrays,
    decontamination,
    edit_fingerprint,
    graph,
    language_id,
    mixing,
    ngram_join,
    pii,
    queries,
    secret_scan,
    sql,
    token_counts,
    url_filter,
    warc,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sql.oracle())
def test_query_equals_twin(spark, data, name):
    assert differences(queries.registry()[name](spark, data), connect(data), sql.oracle()[name]) is None


@pytest.mark.parametrize("name", ["op1_secret_scan", "op5_mixing"])
def test_native_queries_have_no_python(spark, data, name):
    plan = queries.registry()[name](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# words and shingles


def low(text):
    return WORD.findall(text.translate({i: i + 32 for i in range(65, 91)}))


def test_words_do_not_depend_on_slices():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab C\n\té ") for _ in range(rng.randint(0, 90))) for _ in range(300)] + [None, "", "x" * 5000]
    column = pa.array(texts)
    whole = arrays.words(column)
    for limit in (1, 7, 64, 1000):
        part = arrays.words(column, limit=limit)
        assert (part[0] == whole[0]).all() and (part[1] == whole[1]).all()
    names: dict = {}
    for i, text in enumerate(texts):
        own = low(text or "")
        a, b = whole[1][i : i + 2]
        assert b - a == len(own)
        for word, h in zip(own, whole[0][a:b].tolist(), strict=True):
            assert names.setdefault(word, h) == h
    assert len(set(names.values())) == len(names)


def sets(texts, k):
    out = []
    for text in texts:
        own = low(text or "")
        out.append({tuple(own[i : i + k]) for i in range(len(own) - k + 1)} or ({tuple(own)} if own else set()))
    return out


def near_corpus(rng):
    """Clusters of copies with edits around the threshold, a hot family, exact copies, a passage that many share."""
    words = [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(25)]
    texts = []
    for family in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(3, 80))]
        for _ in range(90 if family == 0 else rng.randint(1, 9)):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                own[rng.randrange(len(own))] = rng.choice(words)
            if rng.random() < 0.2:
                own += [rng.choice(words) for _ in range(rng.randint(1, 6))]
            if rng.random() < 0.3:
                own += passage
            texts.append(" ".join(own))
    return texts + ["", None, " \n", "one", "One", "two words"]


def brute_components(ids, texts, k, percent):
    own = sets(texts, k)
    label = list(range(len(ids)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, j in itertools.combinations(range(len(ids)), 2):
        both = len(own[i] & own[j])
        if own[i] and own[j] and 100 * both >= percent * (len(own[i]) + len(own[j]) - both):
            a, b = root(i), root(j)
            label[a] = b
    least: dict = {}
    for i, doc_id in enumerate(ids):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return {doc_id: (len(own[i]), least[root(i)]) for i, doc_id in enumerate(ids)}


@pytest.mark.parametrize("k,percent,cell", [(4, 85, 1000), (5, 80, 20), (1, 60, 1000)])
def test_near_copies_by_brute_force(spark, monkeypatch, k, percent, cell):
    monkeypatch.setattr(ngram_join, "CELL_CLASSES", cell)
    rng = random.Random(k)
    texts = near_corpus(rng)
    ids = rng.sample(range(1000), len(texts))
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(3)
    found = ngram_join.ngram_jaccard(docs, k, percent).collect()
    assert {r[0]: (r[1], r[2]) for r in found} == brute_components(ids, texts, k, percent)


def test_components_of_a_long_chain(spark):
    n = 300
    order = random.Random(3).sample(range(n), n)
    edges = [(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (1001, 1001), (None, 5)]
    found = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert dict(map(tuple, found)) == dict.fromkeys(range(n), 0) | {1000: 1000, 1001: 1000}


# decontamination


def test_masks_are_hit_after_all_changes_that_are_allowed():
    for n in range(7, decontamination.WINDOW + 1):
        places = [
            {at + i for i, c in enumerate(mask) if c == "1"}
            for mask in decontamination.MASKS
            for at in range(n - len(mask) + 1)
        ]
        for changed in itertools.combinations(range(n), int(decontamination.spare(n))):
            assert any(not place & set(changed) for place in places)
    assert decontamination.spare(decontamination.WINDOW) == decontamination.TOLERANCE == 2


def brute_leaks(texts, items):
    def tokens(text):
        return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())

    found = set()
    for d, text in texts:
        own = tokens(text)
        for i, item in items:
            passage = tokens(item)
            need = min(len(passage), decontamination.WINDOW)
            if need < min(map(len, decontamination.MASKS)):
                continue
            spare = 2 if need == 13 else 1 if need >= 10 else 0
            if any(
                sum(x == y for x, y in zip(own[a : a + need], passage[b : b + need], strict=True)) >= need - spare
                for a in range(len(own) - need + 1)
                for b in range(len(passage) - need + 1)
            ):
                found.add((d, i))
    return found


def test_leaks_by_brute_force(spark):
    rng = random.Random(5)
    words = [f"t{i}" for i in range(60)] + ["Öl", "été"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([5, 7, 10, 13, 20, 40])))) for i in range(25)]
    texts = []
    for d in range(150):
        own = [rng.choice(words) for _ in range(rng.randint(0, 40))]
        if d % 3:
            passage = rng.choice(items)[1].split()
            at = rng.randint(0, max(0, len(passage) - 13))
            passage = passage[at : at + rng.randint(9, 30)]
            for _ in range(rng.randint(0, 3)):
                passage[rng.randrange(len(passage))] = rng.choice(words)
            cut = rng.randint(0, len(own))
            own[cut:cut] = [w.upper() if rng.random() < 0.3 else w + rng.choice(["", ",", "."]) for w in passage]
        texts.append((d, " ".join(own)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    found = decontamination.leaks(docs, spark.createDataFrame(items, "item_id long, text string"))
    expected = brute_leaks(texts, items)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == expected and len(expected) > 30


# URL filter


def test_filter_has_no_false_negative_and_few_false_positives(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"))
    table = spark.sparkContext.broadcast(url_filter.build_filter(keys))

    def passed(frame):
        hashed = frame.withColumn("h", F.xxhash64("key")).withColumn("bits", F.xxhash64(F.lit(1), "key"))
        return hashed.mapInArrow(url_filter.maybe_listed(table), hashed.schema).count()

    assert passed(keys) == 5000
    assert passed(spark.range(20_000).select(F.concat(F.lit("other"), "id").alias("key"))) < 400


# token counts


def test_token_counts_as_the_library_has_them(spark, data):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    library = Tokenizer.from_file(path)
    rng = random.Random(3)
    letters = [*map(chr, range(0x250)), "\u3000", "一", "😀", "\u0558", "\u200b", "\u2028", "가", "ب", "aaa", " ", "\n", "<|endoftext|>", "'s", " the"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["a" * 5000, "ab" * 3000 + "aab" * 100, " " * 999, "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r for r in token_counts.token_counts(docs, path, 50).collect()}
    for i, text in enumerate(texts):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert tuple(found[i]) == (i, len((text or "").encode()), n, n > 50)
    rows = queries.op4_token_counts(spark, data).collect()
    given = dict(queries.table(spark, data, "documents").select("doc_id", "text").collect())
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {
        d: len(library.encode(t or "", add_special_tokens=False).ids) for d, t in given.items()
    }


def test_settled_characters_are_parted_as_by_the_library():
    import regex
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_path()).pre_tokenizer
    pattern, settled = regex.compile(token_counts.PRE_TOKENS), regex.compile(token_counts.SETTLED)
    for point in itertools.chain(range(0x3200), range(0x3200, 0xD800, 13)):
        character = chr(point)
        if settled.fullmatch(character):
            text = f"a{character}{character} b{character}7"
            assert pattern.findall(text) == [text[a:b] for _, (a, b) in library.pre_tokenize_str(text)]


# mixing


def brute_targets(sizes, weights, share, cap):
    left, open_, target = share * sum(sizes), set(range(len(sizes))), {}
    while True:
        total = sum(weights[i] for i in open_)
        above = {i for i in open_ if weights[i] * left / total > cap * sizes[i]}
        if not above:
            return target | {i: weights[i] * left / total for i in open_}
        for i in above:
            target[i] = cap * sizes[i]
            left -= target[i]
        open_ -= above
        if not open_:
            return target


@pytest.mark.parametrize("share", [0.2, 1.0, 1.5, 1.99, 2.0])
def test_water_filling_by_brute_force(spark, share):
    rng = random.Random(7)
    sizes = [rng.choice([1, 10, 100, 5000]) * rng.randint(1, 9) for _ in range(17)]
    rows = [(f"s{i:02}", size) for i, size in enumerate(sizes)]
    found = mixing.targets(spark.createDataFrame(rows, "source string, source_size long").repartition(4), (3, 1, 2), share, 2.0)
    expected = brute_targets(sizes, [(3, 1, 2)[i % 3] for i in range(17)], share, 2.0)
    for r in found.collect():
        assert r["target"] == pytest.approx(expected[r["place"]], rel=1e-9)


def test_mix_repeats_whole_texts(spark, data):
    docs = queries.table(spark, data, "documents").where("text is not null")
    plan = mixing.mix(docs)
    assert sorted(plan.collect()) == sorted(mixing.mix(docs.repartition(5)).collect())
    mixed = mixing.repeat_texts(docs, plan)
    words = mixed.groupBy("doc_id").agg(F.sum(mixing.word_count(F.col("text"))).alias("words"))
    assert words.join(plan, "doc_id").where("words <> taken").count() == 0
    assert words.count() == plan.where("taken > 0").count()


# archives


def test_loser_tree_sorts():
    rng = random.Random(2)
    for k in (0, 1, 2, 3, 7, 20):
        runs = [sorted(rng.randint(0, 30) for _ in range(rng.randint(0, 9))) for _ in range(k)]
        assert list(warc.LoserTree([iter(r) for r in runs], lambda x: x)) == sorted(itertools.chain(*runs))


def test_index_is_in_order_and_records_come_back(spark, data, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ENTRIES_PER_RANGE", 9)
    folder = str(tmp_path / "warc")
    pages = queries.table(spark, data, "pages").repartition(4)
    index = warc.write_archives(pages, folder)
    entries = [tuple(r)[:3] for r in index.orderBy("range", "place").collect()]
    assert index.select("range").distinct().count() > 1 and index.select("run").distinct().count() > 1
    assert entries == sorted(entries, key=lambda e: (e[0].encode(), e[1], e[2]))
    back = {r["page_id"]: r for r in warc.read_archives(index, folder).collect()}
    for page in pages.collect():
        record = back[page["page_id"]]
        assert record["url"] == page["url"]
        holder = back[record["refers_to"]] if record["record_type"] == "revisit" else record
        assert holder["record_type"] == "response" and holder["html"] == page["html"]


@pytest.mark.parametrize("kind", ["long", "string"])
def test_ids_of_any_size_and_kind(spark, tmp_path, kind):
    ids = [2**62, -(2**62), 2**40, 0, None, None, None] if kind == "long" else ["b/ä>", "a\r\nb", "none", "", None, None, "z"]
    rows = [(i, "http://a.example/x", f"payload {n // 2}", 10**15 * (n - 3)) for n, i in enumerate(ids)]
    pages = spark.createDataFrame(rows, f"page_id {kind}, url string, html string, t long").repartition(3)
    for time in (None, "t"):
        folder = str(tmp_path / f"{kind}{time}")
        index = warc.write_archives(pages, folder, time_column=time)
        back = sorted(warc.read_archives(index, folder).collect(), key=lambda r: (r["range"], r["place"]))
        assert index.schema["page_id"].dataType.simpleString() == {"long": "bigint"}.get(kind, kind)
        assert sorted(map(str, ids)) == sorted(str(r["page_id"]) for r in back)
        entries = [(r["at"], r["page_id"]) for r in index.orderBy("range", "place").collect()]
        assert entries == sorted(entries, key=lambda e: (e[0], e[1] is not None, e[1] if isinstance(e[1], int) else (e[1] or "").encode()))
        assert [e[1] for e in entries] == [r["page_id"] for r in back]
        by_payload = {}
        for i, _, html, _ in rows:
            by_payload.setdefault(html, []).append(i)
        for r in back:
            if r["record_type"] == "revisit":
                assert any(r["page_id"] in group and r["refers_to"] == max(i for i in group if i is not None) for group in by_payload.values())


def test_captures_of_one_url_without_ids_have_many_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ENTRIES_PER_RANGE", 20)
    monkeypatch.setattr(warc, "PIECE_BYTES", 1500)
    pages = spark.range(400).selectExpr("cast(null as long) AS page_id", "'http://a.example/' AS url", "concat('p', id) AS html").repartition(4)
    folder = str(tmp_path / "warc")
    index = warc.write_archives(pages, folder)
    sizes = [r["count"] for r in index.groupBy("range").count().collect()]
    assert len(sizes) > 10 and max(sizes) < 100
    assert index.groupBy("run", "piece").count().count() > 20
    assert {r["html"] for r in warc.read_archives(index, folder).collect()} == {f"p{i}" for i in range(400)}


def test_exported_files_are_archives(spark, data, tmp_path, monkeypatch):
    import gzip

    monkeypatch.setattr(warc, "PIECE_BYTES", 20_000)
    folder, target = str(tmp_path / "warc"), tmp_path / "files"
    target.mkdir()
    pages = queries.table(spark, data, "pages").repartition(3)
    index = warc.write_archives(pages, folder)
    written = {r["run"]: r["bytes"] for r in warc.export_files(spark, folder, str(target)).collect()}
    files = {p.name.removesuffix(".warc.gz"): p for p in target.iterdir()}
    assert {n: p.stat().st_size for n, p in files.items()} == written and len(written) == index.select("run").distinct().count()
    records = b"".join(gzip.decompress(p.read_bytes()) for p in files.values())
    assert records.count(b"WARC/1.1\r\n") == pages.count()


# personal data

PATTERNS = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def brute_spans(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            double = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            fits = (
                True,
                all(int(x) <= 255 for x in m.group().split(".")) if kind == 1 else False,
                14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in double) % 10 == 0,
                10 <= len(digits) <= 15,
            )
            if fits[kind]:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def test_spans_by_brute_force():
    rng = random.Random(3)
    parts = ["12", "255", "256", ".", "1.2.3.4", "4111 1111-1111 1111", "4111111111111111", "+1 (017) 555-7713", " ", "-", "a@b.c", "@", "a.b", "+", "0", "é", "\n"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 10)))
        assert [s for s in pii.find_spans(text) if s[1] < 4] == brute_spans(text), text


def test_further_kinds():
    text = "see https://bob:pw1@host/x IBAN: DE89370400440532013000, iban DE89370400440532013001"
    assert [pii.KINDS[k] for _, k, _ in pii.find_spans(text)] == ["login", "account"]
    assert pii.redact_text(text).startswith("see [LOGIN]host/x IBAN: [ACCOUNT], iban DE89")


# secrets


def test_ledger_scans_only_what_is_new(spark, tmp_path):
    token = "token = abcdef0123456789abcd"
    first = spark.createDataFrame([("a", token), ("b", token), ("c", "nothing")], "path string, text string")
    ledger = secret_scan.SecretLedger(spark, str(tmp_path), secret_scan.BASE_RULES)
    ledger.update(first)
    assert ledger.scanned().count() == 2 * 3
    _, scanned = secret_scan.scan_history(first, ledger.scanned(), secret_scan.BASE_RULES)
    assert scanned.count() == 0
    second = spark.createDataFrame([("d", token), ("e", "AKIA" + "A" * 20)], "path string, text string")
    findings, scanned = secret_scan.scan_history(second, ledger.scanned(), secret_scan.BASE_RULES)
    assert scanned.count() == 3 and {r["rule"] for r in findings.collect()} == {"access"}
    ledger.update(second)
    found = secret_scan.findings_by_path(first.union(second), ledger.findings()).collect()
    assert {r["path"]: [f["rule"] for f in r["findings"]] for r in found} == {
        "a": ["assign", "hex"], "b": ["assign", "hex"], "c": [], "d": ["assign", "hex"], "e": ["access"],
    }
    newer = secret_scan.Rule("hex", 2, "[0-9a-f]{8,}", 0, 8, "[0-9a-f]{8}")
    _, scanned = secret_scan.scan_history(first, ledger.scanned(), (*secret_scan.BASE_RULES[:2], newer))
    assert {(r["rule"], r["version"]) for r in scanned.collect()} == {("hex", 2)} and scanned.count() == 2


# language


def test_held_out_accuracy(spark, data):
    found = queries.op9_language_id(spark, data)
    assert sorted(found.collect()) == sorted(queries.op9_language_id(spark, data).collect())
    joined = found.join(queries.table(spark, data, "documents").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in joined if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in joined)
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)


# fingerprints


def brute_print(text):
    """The walk of one text, a step at a time."""
    digits, classes = edit_fingerprint.character_classes()
    rng = np.random.default_rng(20240607)
    out, at, step, octave = "", 0, 0, 0
    while at < len(text):
        if step % 4096 == 0:
            coins = rng.integers(0, 2, (4096, 64), dtype=np.uint8)
        steps = edit_fingerprint.sampled_steps(octave)
        if step in steps:
            out += "0123456789abcdef"[digits[ord(text[at])]]
            octave += step == steps[-1]
        at += int(coins[step % 4096][classes[ord(text[at])]])
        step += 1
    return out


def test_walks_by_brute_force():
    rng = random.Random(4)
    texts = ["".join(rng.choice("abc dé😀") for _ in range(rng.choice([0, 1, 2, 30, 300, 5000]))) for _ in range(40)]
    assert edit_fingerprint.fingerprint_texts(texts) == [brute_print(t) for t in texts]


def test_edited_texts_follow_descending_ids(spark):
    rng = random.Random(6)
    rows = [(i, "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 200)))) for i in rng.sample(range(5000), 700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r["doc_id"]: r for r in edit_fingerprint.edited_likeness(docs).collect()}
    ordered = sorted(rows, reverse=True)
    for (doc_id, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, next_, changed = brute_print(text), brute_print(after), brute_print(edited)
        assert tuple(found[doc_id]) == (
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, changed,
            edit_fingerprint.likeness(own, changed), edit_fingerprint.likeness(own, next_),
        )


def test_near_texts_are_found(spark):
    rng = random.Random(8)
    rows = []
    for i in range(60):
        text = "".join(rng.choice("abcdefghij klmno") for _ in range(800))
        cut = rng.randint(600, 790)
        rows += [(i, text), (100 + i, text[:cut] + "X" + text[cut:]), (200 + i, text)]
    prints = edit_fingerprint.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))
    found = {(r["query_id"], r["doc_id"]) for r in edit_fingerprint.near_texts(prints.where("doc_id < 100"), prints).collect()}
    assert {(i, 200 + i) for i in range(60)} <= found
    assert sum((i, 100 + i) in found for i in range(60)) >= 54
    assert all(a % 100 == b % 100 for a, b in found)


def test_recall_of_the_bands(spark, data):
    docs = queries.table(spark, data.replace("sf0.001", "sf0.01"), "documents")
    prints = edit_fingerprint.fingerprints(docs).select("doc_id", "fingerprint")
    rows = [r for r in prints.collect() if r["fingerprint"]]
    asked = [r for r in rows if r["doc_id"] % 5 == 0]
    wanted = {
        (a["doc_id"], b["doc_id"])
        for a in asked
        for b in rows
        if a["doc_id"] != b["doc_id"] and abs(len(a["fingerprint"]) - len(b["fingerprint"])) <= 32
        and edit_fingerprint.likeness(a["fingerprint"], b["fingerprint"]) >= edit_fingerprint.LEAST
    }
    near = edit_fingerprint.near_texts(prints.where("doc_id % 5 = 0"), prints).collect()
    found = {(r["query_id"], r["doc_id"]) for r in near}
    unlike = {p for p in wanted if edit_fingerprint.likeness(*[next(r["fingerprint"] for r in rows if r["doc_id"] == i) for i in p]) < 1}
    assert len(found) == len(near) and found <= wanted and len(unlike) >= 10
    assert len(found) >= 0.9 * len(wanted) and len(found & unlike) >= 0.9 * len(unlike)


def test_registered_neighbours_are_counted_by_class(spark, tmp_path):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdefgh ijklmno") for _ in range(700)) for _ in range(40)]
    rows = [(i, texts[0] if i % 3 == 0 else texts[i % 40]) for i in range(301)] + [(400, None), (500, "short"), (501, "short")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in queries.op10_edit_fingerprint(spark, str(tmp_path)).collect()}
    assert len(found) == len(rows)
    assert all((r["n_near"] is None) == (i % 100 != 0) for i, r in found.items())
    for i in (0, 100, 200, 300, 500):
        same = [d for d, t in rows if t == dict(rows)[i]]
        assert (found[i]["n_near"], found[i]["near_least"]) == (len(same) - 1, min(same))
    assert (found[400]["n_near"], found[400]["near_least"]) == (0, 400)


# pipeline


def test_pipeline_by_brute_force(spark, data):
    docs = queries.table(spark, data, "documents")
    rows = [r.asDict() for r in corpus_pipeline.languages(spark, docs, data).collect()]
    assert len(rows) >= 0.99 * docs.count()
    ids = sorted(r["doc_id"] for r in rows)
    texts = {r["doc_id"]: r["text"] for r in rows}
    groups = brute_components(ids, [texts[i] for i in ids], 5, 80)
    kept = [i for i in ids if groups[i][1] == i]
    items = [tuple(r) for r in queries.table(spark, data, "benchmark").select("item_id", "text").collect()]
    leaking = {d for d, _ in brute_leaks([(i, texts[i]) for i in kept if len(texts[i]) < 6000], items)}
    final = {r["doc_id"]: r for r in corpus_pipeline.run(spark, data).collect()}
    assert set(final) <= set(kept) and not set(final) & leaking
    assert {i for i in kept if len(texts[i]) < 6000} - leaking <= set(final)
    for doc_id, row in final.items():
        assert row["size"] == len(WORD.findall(pii.redact_text(texts[doc_id])))

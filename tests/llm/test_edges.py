"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, for every operator."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clickmart.llm import (
    decontamination,
    edit_fingerprint,
    language_id,
    mixing,
    ngram_join,
    pii,
    queries,
    secret_scan,
    token_counts,
    url_filter,
    warc,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SENTENCE = "the quick brown fox jumps over the lazy dog while nine grey cats watch from a warm wall"
ROWS = [
    (1, SENTENCE, "en", "a", 0),
    (2, SENTENCE, "en", "a", 0),
    (2, SENTENCE, "en", "a", 0),
    (3, "", None, "b", None),
    (4, None, "de", None, None),
    (5, "Straße und Öl mail me@host.example now", "de", None, 0),
    (6, "x", "en", "b", 0),
    (7, "... 123 !!!", "en", "b", 0),
    (None, SENTENCE, None, "c", 0),
    (9, "word " * 60_000, "en", "c", 0),
    (10, "a" * 300_000, "en", "c", 0),
]
CLASH = ["id", "node", "n", "size", "taken", "target", "blob", "findings", "token", "score", "rejected", "part", "h", "cell", "home", "hash"]


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    for name in CLASH:
        frame = frame.withColumn(name, F.lit("clash"))
    return frame


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def by_id(frame):
    return {r["doc_id"]: r.asDict() for r in frame.collect()}


def benchmark(spark):
    return spark.createDataFrame([(1, SENTENCE), (2, None), (3, ""), (4, "too short")], "item_id long, text string")


OPERATORS = {
    "secrets": lambda spark, docs: secret_scan.findings_by_path(docs, secret_scan.scan_history(docs)[0]),
    "leaks": lambda spark, docs: decontamination.leaks(docs, benchmark(spark)),
    "tokens": lambda spark, docs: token_counts.token_counts(docs, queries.tokenizer_path()),
    "mix": lambda spark, docs: mixing.mix(docs),
    "spans": lambda spark, docs: pii.personal_spans(docs),
    "near": lambda spark, docs: ngram_join.ngram_jaccard(docs),
    "language": lambda spark, docs: language_id.predict(
        docs, language_id.train(docs, F.lit(True), "doc_id", "text", "lang")
    ),
    "print": lambda spark, docs: edit_fingerprint.fingerprints(docs),
    "edited": lambda spark, docs: edit_fingerprint.edited_likeness(docs),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, empty, name):
    assert OPERATORS[name](spark, empty).collect() == []


@pytest.mark.parametrize("name", [n for n in OPERATORS if n != "leaks"])
def test_a_row_for_every_row(spark, docs, name):
    found = OPERATORS[name](spark, docs).select("doc_id").collect()
    assert sorted(str(r[0]) for r in found) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_keep_the_columns(spark, docs, empty, tmp_path, name, stage):
    benchmark(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    for frame in (docs, empty):
        out = stage(spark, frame, str(tmp_path))
        out.collect()
        if stage is not corpus_pipeline.mix_sources:
            assert out.columns == docs.columns


def test_near_copies(docs):
    found = by_id(ngram_join.ngram_jaccard(docs))
    assert found[2]["component_id"] == 1 and found[None]["component_id"] == 1
    assert found[3] == {"doc_id": 3, "n_shingles": 0, "component_id": 3}
    assert found[6]["n_shingles"] == 1 and found[9]["n_shingles"] == 1
    kept = {r["doc_id"] for r in ngram_join.keep_one(docs).collect()}
    assert kept == {1, 3, 4, 5, 6, 7, 9, 10}


def test_leaks(spark, docs):
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(docs, benchmark(spark)).collect()}
    assert found == {(1, 1), (2, 1), (None, 1)}
    kept = {r["doc_id"] for r in decontamination.decontaminate(docs, benchmark(spark)).collect()}
    assert kept == {3, 4, 5, 6, 7, 9, 10}
    assert decontamination.leaks(docs, benchmark(spark).where("false")).collect() == []


def test_language(docs):
    model = language_id.train(docs, F.lit(True), "doc_id", "text", "lang")
    found = by_id(language_id.predict(docs.select("doc_id", "text"), model))
    for doc_id in (3, 4, 7):
        assert found[doc_id]["lang_pred"] == "und" and found[doc_id]["score"] == 0 and found[doc_id]["rejected"]
    assert found[5]["lang_pred"] in ("de", "en") and 0 <= found[5]["score"] <= 1


def test_spans_and_redaction(docs):
    assert [s["kind"] for s in by_id(pii.personal_spans(docs))[5]["spans"]] == ["email"]
    clean = by_id(pii.redact(docs))
    assert clean[5]["text"] == "Straße und Öl mail [EMAIL] now" and clean[5]["n_chars"] == 30
    assert clean[4]["text"] is None and clean[1]["text"] == SENTENCE and clean[1]["n_chars"] == 0


def test_mix_takes_null_sources_last(docs):
    found = mixing.mix(docs, (3, 1, 2)).collect()
    sizes = {r["source"]: r["source_size"] for r in found}
    assert sizes["a"] == 3 * 18 and sizes[None] == 6
    taken = {}
    for r in found:
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    for r in found:
        assert abs(taken[r["source"]] - r["target"]) <= 0.5


def test_urls(spark):
    pages = spark.createDataFrame(
        [
            (1, "https://A.Example.org/es/x?y#z", "x"), (2, None, "x"), (3, "no scheme", "x"), (3, "no scheme", "x"), (4, "ftp://org", "x"),
            (5, "http://www.bad.test:80/p/?utm_a=1&b=2&a=1#f", "x"), (None, "x://bad.test/p?a=1&b=2", "x"), (7, "", "x"),
        ],
        "page_id long, url string, key string",
    )
    rules = spark.createDataFrame(
        [*queries.URL_RULES, (None, "/", "block"), ("org", "/", "allow")], "host string, path string, verdict string"
    )
    listed = spark.createDataFrame([("https://bad.test/p/?b=2&a=1",), (None,), ("nothing",)], "url string")
    found = url_filter.judge_urls(pages, rules, listed).collect()
    assert len(found) == 8
    rows = {r["page_id"]: r for r in found}
    assert tuple(rows[1])[1:5] == ("a.example.org", "/es/x", "example.org/es/", "block")
    for page in (2, 3, 7):
        assert tuple(rows[page])[1:5] == ("", "", None, "allow")
    assert tuple(rows[4])[1:5] == ("org", "", None, "allow")
    assert rows[5]["verdict"] == rows[None]["verdict"] == "block" and rows[5]["is_listed"]
    nothing = url_filter.judge_urls(pages, rules.where("false"), listed.where("false")).collect()
    assert {r["verdict"] for r in nothing} == {"allow"}
    assert url_filter.judge_urls(pages.where("false"), rules, listed).collect() == []


def test_archives(spark, tmp_path):
    pages = spark.createDataFrame(
        [
            (1, "http://b.test/\r\n", "<p>é\r\n\r\nx</p>", "c"), (2, None, "<p>é\r\n\r\nx</p>", "c"), (2, None, "<p>é\r\n\r\nx</p>", "c"), (3, "http://a.test/", None, "c"),
            (4, "nothing", "", "c"), (None, "http://a.test/", "", "c"), (None, "u://h", "alone", "c"), (5, "http://a.test/z", "z" * 400_000, "c"),
        ],
        "page_id long, url string, html string, run string",
    )
    folder = str(tmp_path / "warc")
    found = warc.read_archives(warc.write_archives(pages, folder), folder).collect()
    kinds = sorted((str(r["page_id"]), r["record_type"], r["refers_to"], r["payload_bytes"]) for r in found)
    assert kinds == sorted([
        ("1", "revisit", 2, 14), ("2", "response", None, 14), ("2", "response", None, 14), ("3", "revisit", 4, 0), ("4", "response", None, 0),
        ("None", "revisit", 4, 0), ("None", "response", None, 5), ("5", "response", None, 400_000),
    ])
    assert {r["html"] for r in found} == {"<p>é\r\n\r\nx</p>", "", "alone", "z" * 400_000, None}
    nothing = warc.write_archives(pages.where("false"), folder)
    assert warc.read_archives(nothing, folder).collect() == []


def test_mix_spreads_documents_without_id(spark):
    rows = [(None, "s", f"some words of text {i}") for i in range(200)]
    rows += [(None, "t", None), (None, "s", None), (1, "s", "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    first = mixing.mix(docs, share=0.5)
    again = mixing.mix(docs.repartition(7), share=0.5)
    assert sorted(map(str, first.collect())) == sorted(map(str, again.collect()))
    taken = first.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 1 for r in taken)


def test_a_listed_url_blocks_its_other_spellings(spark, tmp_path):
    rows = [
        (1, "https://www.spam.example/a/?b=2&a=1&utm_source=x#top"), (2, "http://spam.example:80/a?a=1&b=2"), (3, "http://spam.example/other"),
        (4, "http://fine.example/a?a=1&b=2"), (5, "http://spamless.example/"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    pages.where("page_id <> 2").write.parquet(f"{tmp_path}/pages.parquet")
    verdicts = {r["page_id"]: r["verdict"] for r in queries.op3_url_filter(spark, str(tmp_path)).collect()}
    assert verdicts == {1: "block", 3: "block", 4: "allow", 5: "allow"}
    listed = pages.where("page_id = 1").select("url")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    judged = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(pages, none, listed).collect()}
    assert judged == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow"}


def test_a_second_update_scans_nothing(spark, data, tmp_path):
    docs = queries.table(spark, data, "documents").select("doc_id", "text")
    ledger = secret_scan.SecretLedger(spark, str(tmp_path / "ledger"))
    ledger.update(docs)
    once = sorted(map(tuple, ledger.findings().collect()))
    _, scanned = secret_scan.scan_history(docs, ledger.scanned())
    assert once and scanned.isEmpty()
    ledger.update(docs)
    assert sorted(map(tuple, ledger.findings().collect())) == once

"""Cases that an operator once left out."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clickmart.llm import (
    decontamination,
    edit_fingerprint,
    language_id,
    ngram_join,
    pii,
    queries,
    token_counts,
)


@pytest.mark.parametrize("away", ["de", "en"])
def test_unlearned_languages_go_and_clean_texts_stay(spark, data, away):
    docs = queries.table(spark, data.replace("sf0.001", "sf0.01"), "documents").where(F.size(F.split("text", " ")) >= 60)
    model = language_id.train(docs, F.col("lang") != away, "doc_id", "text", "lang")
    assert len(model.labels) == 3
    rng = random.Random(3)
    noise = [(i, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz  ") for _ in range(600)), "noise") for i in range(100)]
    docs = docs.select("doc_id", "text", "lang").union(spark.createDataFrame(noise, "doc_id long, text string, lang string"))
    found = {r["lang"]: r["gone"] for r in language_id.predict(docs, model).groupBy("lang").agg(F.avg(F.col("rejected").cast("int")).alias("gone")).collect()}
    assert found[away] >= 0.85 and found["noise"] >= 0.9
    assert all(found[label] <= 0.03 for label in model.labels)


def test_limits_weigh_right_against_foreign_texts():
    right, foreign = np.linspace(0.8, 1, 2000), np.linspace(0.3, 0.75, 2000)
    right[0] = 0.31  # one weak row does not set the limit
    limits = language_id.least_confidence(right, np.full(2000, 900), foreign, np.full(2000, 900))
    assert 0.75 < limits[-1] < 0.81 and limits[0] <= 0.5


def test_items_that_share_a_passage_are_all_reported(spark):
    words = [f"w{i}" for i in range(200)]
    rng = random.Random(9)
    shared = [rng.choice(words) for _ in range(40)]
    own = [[rng.choice(words) for _ in range(8)] for _ in range(12)]
    items = [(100 - i, " ".join(w + shared)) for i, w in enumerate(own)] + [(1, " ".join(shared)), (2, " ".join(shared))]
    texts = [(7, " ".join(["x"] * 5 + shared + ["y"] * 5)), (8, " ".join(own[0] + shared)), (9, "nothing of it " * 5)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(docs, benchmark).collect()}
    assert found == {(d, i) for d in (7, 8) for i, _ in items}
    assert [r["doc_id"] for r in decontamination.decontaminate(docs, benchmark).collect()] == [9]


def test_short_items_and_scripts_without_spaces(spark, tmp_path):
    items = [
        (1, "Paris"), (2, "who wrote it then"), (3, "中国的首都是哪里？"), (4, "ประเทศไทยอยู่ที่ไหน"), (5, "北京"), (6, ""), (7, None),
        (8, "“Don’t stop”\u00a0said—the old man at the gate of our town"), (9, "not there"),
    ]
    texts = [
        (1, "We saw PARIS, in May"), (2, "Who wrote it, then? Nobody"), (3, "问：中国的首都是哪里？答：北京。"), (4, "xxประเทศไทยอยู่ที่ไหนyy"),
        (5, "\"Don't stop\" said - the old man at the gate of our town"), (6, "who wrote it now; parisian there not"), (7, None), (8, ""),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = {(r["doc_id"], r["item_id"]) for r in queries.op2_decontamination(spark, str(tmp_path)).collect()}
    assert found == {(1, 1), (2, 2), (3, 3), (3, 5), (4, 4), (5, 8)}
    kept = decontamination.decontaminate(docs, queries.table(spark, str(tmp_path), "benchmark")).collect()
    assert {r["doc_id"] for r in kept} == {1, 6, 7, 8}, "an item of one or two tokens takes nothing"
    strict = decontamination.decontaminate(docs, queries.table(spark, str(tmp_path), "benchmark"), least_tokens=1).collect()
    assert {r["doc_id"] for r in strict} == {6, 7, 8}


def test_repeated_ids_bring_one_text_each(spark, data):
    docs = queries.table(spark, data, "documents").select("doc_id", "text", "lang")
    again = docs.where("doc_id = 3").withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(1000)))).drop("i")
    once = language_id.train(docs, F.lit(True), "doc_id", "text", "lang")
    often = language_id.train(docs.union(again), F.lit(True), "doc_id", "text", "lang")
    assert once.labels == often.labels and np.array_equal(once.embed, often.embed) and once.least == often.least


def test_without_labels_nothing_is_judged(spark):
    rows = [(1, "some words of a text", None), (2, None, None), (3, "...", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(map(tuple, language_id.keep_known(docs).collect())) == rows


def test_given_labels_stay_and_nulls_are_filled(spark, data):
    docs = queries.table(spark, data, "documents").where(F.size(F.split("text", " ")) >= 60)
    changed = docs.withColumn("lang", F.when(F.col("doc_id") % 4 != 0, F.col("lang")))
    kept = language_id.keep_known(changed).join(docs.select("doc_id", F.col("lang").alias("truth")), "doc_id").collect()
    assert kept and all(r["lang"] is not None for r in kept)
    assert sum(r["lang"] == r["truth"] for r in kept) >= 0.97 * len(kept)


SENTENCE = "the quick brown fox jumps over the lazy dog while nine grey cats watch from a warm wall"


def test_stages_go_by_rows_and_not_by_ids(spark):
    other = "an altogether different text that nobody else has written down so far in this table"
    rows = [(None, SENTENCE, [1])] * 4 + [(5, other, [2]), (5, SENTENCE, [3]), (6, "", [4]), (6, "", [4]), (7, None, [5]), (8, other, [6]), (8, other, [6])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, more array<int>").repartition(3)
    kept = sorted(map(tuple, ngram_join.keep_one(docs).collect()), key=str)
    assert kept == sorted([(5, other, [2]), (5, SENTENCE, [3]), (6, "", [4]), (6, "", [4]), (7, None, [5])], key=str)
    assert ngram_join.keep_one(docs.where("doc_id is null")).collect() == [docs.where("doc_id is null").first()]
    items = spark.createDataFrame([("q", other)], "item_id string, text string")
    clean = decontamination.decontaminate(docs, items).collect()
    assert sorted(map(tuple, clean), key=str) == sorted([r for r in rows if r[1] != other], key=str)


def test_ids_may_be_text(spark, data):
    docs = queries.table(spark, data, "documents").where("length(text) < 3000")
    named = docs.withColumn("doc_id", F.format_string("doc-%05d", "doc_id"))
    benchmark = queries.table(spark, data, "benchmark")
    text_items = benchmark.withColumn("item_id", F.format_string("item-%05d", "item_id"))
    operators = [
        lambda d: token_counts.token_counts(d, queries.tokenizer_path()),
        pii.personal_spans,
        edit_fingerprint.fingerprints,
        edit_fingerprint.edited_likeness,
        lambda d: ngram_join.ngram_jaccard(d, 4, 85),
        lambda d: decontamination.leaks(d, benchmark),
    ]
    for operator in operators:
        found, by_name = operator(docs), operator(named)
        assert by_name.columns == found.columns and by_name.schema["doc_id"].dataType.simpleString() == "string"
        ids = [c for c in ("doc_id", "component_id") if c in found.columns]
        wanted = found.withColumns({c: F.format_string("doc-%05d", c) for c in ids})
        assert sorted(map(str, by_name.collect())) == sorted(map(str, wanted.collect()))
    pairs = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(docs, benchmark).collect()}
    by_text = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(docs, text_items).collect()}
    assert pairs and by_text == {(d, f"item-{i:05d}") for d, i in pairs}


def test_pipeline_takes_text_ids(spark, data, tmp_path):
    docs = queries.table(spark, data, "documents")
    docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id")).withColumn("n_chars", F.lit("many")).write.parquet(f"{tmp_path}/documents.parquet")
    queries.table(spark, data, "benchmark").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert 0.7 * docs.count() < len(found) < docs.count() and all(i.startswith("d") for i in found)

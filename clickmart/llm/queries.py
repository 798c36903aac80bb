"""Registered queries of the operators: each reads its whole table and returns the digest of its operator's rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.llm import (
    decontamination,
    edit_fingerprint,
    language_id,
    mixing,
    ngram_join,
    periodic_runs,
    pii,
    prefix_trie,
    secret_scan,
    sharding,
    token_counts,
    url_filter,
    warc,
)
from clickmart.operators.materialize import checkpoint_root, materialize

# Production parameters.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
# Words of a host name for which a URL is listed.
LISTED_WORDS = (
    "ads adult bet bets betting casino gambling jackpot loans lottery pharmacy pills poker porn sex slots spam viagra xxx"
).split()
TOKEN_LIMIT = 512
SHARDS = 40
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def written(spans: Column, kind: str) -> Column:
    """kind:start:end of sorted spans, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s[kind], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def counted(spans: Column, field: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s[field] == kind)).cast("long").alias(f"n_{kind}")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = secret_scan.SecretLedger(spark, f"{checkpoint_root(spark)}/secrets-{uuid.uuid4().hex}")
    ledger.update(docs)
    found = secret_scan.findings_by_path(docs, ledger.findings())
    names = [rule.name for rule in secret_scan.RULES]
    order = F.array(*[F.lit(n) for n in names])
    placed = F.sort_array(
        F.transform(
            "findings",
            lambda f: F.struct(
                f["start"].alias("start"), F.array_position(order, f["rule"]).alias("place"), f["rule"].alias("rule"), f["end"].alias("end")
            ),
        )
    )
    base = [rule.name for rule in secret_scan.BASE_RULES]
    found = found.select("doc_id", placed.alias("spans"))
    return found.select(
        "doc_id",
        *[counted(F.col("spans"), "rule", name) for name in base],
        F.sha2(written(F.filter("spans", lambda s: s["rule"].isin(base)), "rule"), 256).alias("base_sha256"),
        written(F.col("spans"), "rule").alias("spans"),
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), short_items=True)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    words = F.split(url_filter.url_host(F.col("url")), "[.-]")
    listed = pages.where(F.arrays_overlap(words, F.array(*map(F.lit, LISTED_WORDS)))).select("url")
    return url_filter.judge_urls(pages, rules, listed)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path(), TOKEN_LIMIT)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, max_epochs=2.0)
    return plan.select("doc_id", "size", "source_size", "target", "taken", "source")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.archive_folder(spark)
    index = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    records = warc.read_archives(index, folder, payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = pii.personal_spans(table(spark, sf_dir, "documents"))
    base = list(pii.BASE_KINDS)
    return spans.select(
        "doc_id",
        *[counted(F.col("spans"), "kind", kind) for kind in base],
        F.sha2(written(F.filter("spans", lambda s: s["kind"].isin(base)), "kind"), 256).alias("base_sha256"),
        written(F.col("spans"), "kind").alias("spans"),
    )


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_jaccard(table(spark, sf_dir, "documents"), k=4, percent=85)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = language_id.train(docs, ~held_out, "doc_id", "text", "lang")
    predicted = language_id.predict(docs.select("doc_id", "text"), model)
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op10_edit_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Besides the likenesses, for documents whose id is divisible by 100: how many others are near, and the smallest id of them and itself."""
    docs = table(spark, sf_dir, "documents")
    found = edit_fingerprint.edited_likeness(docs)
    asked = F.col("doc_id") % 100 == 0
    prints = edit_fingerprint.fingerprints(docs.where(asked)).select("doc_id", "fingerprint")
    near = edit_fingerprint.near_classes(prints, edit_fingerprint.fingerprints(docs))
    near = near.groupBy(F.col("asked").alias("fingerprint")).agg(F.sum("n").alias("n"), F.min("least_id").alias("near_least"))
    near = materialize(near)  # a row for each distinct text that was asked about
    return found.join(near, "fingerprint", "left").select(
        *found.columns,
        F.when(asked, F.coalesce(F.col("n") - 1, F.lit(0))).alias("n_near"),
        F.when(asked, F.coalesce("near_least", "doc_id")).alias("near_least"),
    )


def with_periods(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) where each document whose h = crc32(doc_id) ends in 0 repeats a stretch of its words to its end.

    With g = h / 10, n words: from word a = g % n on, the p = 1 + (n - a) / (3 + g % 8) words there are repeated. A null
    doc_id changes nothing.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = docs.select(
        "doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("words")
    )
    n = F.size("words")
    start = (F.col("g") % n).cast("int")
    chosen = chosen.withColumn("a", F.when(n > 0, start))
    period = (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    chosen = chosen.withColumn("p", period)
    times = F.ceil((n - F.col("a")) / F.col("p")).cast("int")
    repeated = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times))
    changed = F.array_join(F.slice(F.concat(F.slice("words", F.lit(1), F.col("a")), repeated), F.lit(1), n), " ")
    return chosen.select("doc_id", F.when(F.col("a").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_periods(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs.periodic_runs(docs)
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    # A quotient of doubles tells any two fractions of such sizes apart, below 100 million words a text.
    best = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(
                (r["length"] / r["period"]).alias("exponent"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"), r["length"].alias("length")
            ),
        )
    )
    found = found.withColumn("best", best)
    length, period = F.col("best.length"), -F.col("best.shorter")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.before")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        ((1000 * length - (1000 * length) % period) / period).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Conversations c (conv_id, turns) whose first h = crc32(c) % 4 turns are replaced by those of conversation c - c % 20."""
    c = F.col("conv_id")
    heads = conversations.where(c % 20 == 0).select(c.alias("base"), F.slice("turns", 1, 3).alias("head"))
    h = (F.crc32(c.cast("string")) % 4).cast("int")
    own = conversations.select("conv_id", "turns", h.alias("h"), (c - c % 20).alias("base")).join(heads, "base", "left")
    none = F.array().cast("array<struct<key:string,words:int>>")
    head = F.slice(F.coalesce("head", none), F.lit(1), F.col("h"))
    rest = F.when(F.size("turns") > F.col("h"), F.slice("turns", F.col("h") + 1, F.size("turns"))).otherwise(none)
    return own.select("conv_id", F.concat(head, rest).alias("turns"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = prefix_trie.conversation_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(rebuilt(materialize(conversations)))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    narrow = docs.select(
        "doc_id",
        (F.octet_length("text") + 16).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32"),
        F.md5("text").alias("text_md5"),  # equal texts are a group
    )
    placed = sharding.shard(narrow, SHARDS, F.col("text_md5"), F.col("size"), F.md5(F.col("doc_id").cast("string")))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    queries = (
        op1_secret_scan,
        op2_decontamination,
        op3_url_filter,
        op4_token_counts,
        op5_mixing,
        op6_warc,
        op7_pii,
        op8_ngram_jaccard,
        op9_language_id,
        op10_edit_fingerprint,
        op11_periodic_runs,
        op12_prefix_trie,
        op13_sharding,
    )
    return {query.__name__: query for query in queries}

"""URL filters: a blocked Bloom filter passes what may be listed, an exact hash join tells what is.

The list holds canonical URLs and host/path rules. Every URL asks for its canonical form and for each pair of
a domain above its host and a beginning of its path that has the length of some rule's path.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORDS = 8  # of 32 bits in a block: one key sets one bit in each
BITS_PER_KEY = 16
MOST_BLOCKS = 1 << 18  # 8 MB; beyond that more URLs pass and the join does more of the work


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty for a null or a URL without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(url: Column) -> Column:
    """Host without ``www.`` and default port, path without a closing slash, sorted parameters without tracking.

    Fragment and scheme go. Null for a null URL or one without ``://``.
    """
    host = F.regexp_replace(F.regexp_replace(url_host(url), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(url_path(url), r"/+$", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&", -1), lambda p: (p != "") & ~p.rlike(r"^(utm_|ref=)"))
    return F.when(url.contains("://"), F.concat_ws("?", F.concat(host, path), F.when(F.size(kept) > 0, F.array_join(F.array_sort(kept), "&"))))


def build_filter(keys: DataFrame) -> np.ndarray:
    """Blocked Bloom filter of the column ``key``, at most MOST_BLOCKS blocks of 256 bits.

    Blocks are put together by the cluster; the driver gets the filter, whose size is bounded, not the keys.
    """
    n = keys.count()
    blocks = 1
    while blocks * 32 * WORDS < n * BITS_PER_KEY and blocks < MOST_BLOCKS:
        blocks *= 2
    bits = F.xxhash64(F.lit(1), "key")
    words = [
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(bits, {5 * i}) & 31 as int))")).alias(f"w{i}") for i in range(WORDS)
    ]
    rows = keys.select(F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block"), bits.alias("bits"))
    table = np.zeros((blocks, WORDS), np.uint32)
    for row in rows.groupBy("block").agg(*words).toLocalIterator():
        table[row["block"]] = row[1:]
    return table


def maybe_listed(filter_):
    """Rows whose key, by its hashes ``h`` and ``bits``, passes the filter."""

    def run(batches: Iterable[pa.RecordBatch]):
        table = filter_.value
        for batch in batches:
            h = batch.column("h").to_numpy(zero_copy_only=False)
            bits = batch.column("bits").to_numpy(zero_copy_only=False).view(np.uint64)
            block = table[np.mod(h, len(table))]
            kept = np.ones(len(h), bool)
            for i in range(WORDS):
                wanted = (bits >> np.uint64(5 * i)) & np.uint64(31)
                kept &= (block[:, i] >> wanted.astype(np.uint32)) & 1 == 1
            yield batch.filter(pa.array(kept))

    return run


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    listed: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """(page_id, host, path, rule, verdict, is_listed) for every row of ``pages``.

    ``rules`` (host, path, verdict) fit their host and all domains below it, if the URL's path starts with theirs;
    of several the longest one wins as it is written, host before path on ties. ``listed`` (url) is blocked where
    no rule fits, compared by canonical form; everything else is allowed. A null URL, or one without ``://``, has empty
    host and path, fits nothing and is allowed. Repeated rows get one row each; repeated rules and listed URLs count once, and a rule given with both
    verdicts blocks. Null rules or listed URLs are ignored. Other columns are not read. Empty tables are fine.
    """
    rules = rules.where("host is not null and path is not null").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    rule_keys = rules.select(
        F.concat(F.lit("rule "), "host", "path").alias("key"), "host", "path", "verdict"
    )
    canonical = canonical_url(F.col(url_column))
    listed_keys = (
        listed.select(F.concat(F.lit("url "), canonical_url(F.col("url"))).alias("key")).where("key is not null").distinct()
    )
    none = F.lit(None).cast("string")
    keys = rule_keys.unionByName(
        listed_keys.select("key", none.alias("host"), none.alias("path"), none.alias("verdict"))
    )
    filter_ = pages.sparkSession.sparkContext.broadcast(build_filter(keys.select("key")))
    # Lengths, not rules, come to the driver: no more than the longest URL has characters.
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect())

    narrow = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).cast("string").alias("url"))
    urls = narrow.where("url is not null").distinct()
    asked = urls.select(
        "page_id", "url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"),
        canonical_url(F.col("url")).alias("canonical"),
    ).where("canonical is not null")
    labels = F.split("host", r"\.", -1)
    above = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    starts = F.filter(
        F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths])
        if lengths
        else F.array().cast("array<string>"),
        lambda p: p.isNotNull(),
    )
    by_rule = F.flatten(
        F.transform(above, lambda host: F.transform(starts, lambda p: F.concat(F.lit("rule "), host, p)))
    )
    probes = F.array_distinct(F.concat(by_rule, F.array(F.concat(F.lit("url "), "canonical"))))
    asked = asked.select("page_id", "url", "host", "path", F.explode(probes).alias("key"))
    asked = asked.withColumn("h", F.xxhash64("key")).withColumn("bits", F.xxhash64(F.lit(1), "key"))
    passed = asked.mapInArrow(maybe_listed(filter_), T.StructType(asked.schema.fields)).drop("h", "bits")

    exact = passed.join(
        keys.select("key", F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict"), "key"
    )
    fits = (
        F.col("rule_host").isNotNull()
        & ((F.col("host") == F.col("rule_host")) | F.col("host").endswith(F.concat(F.lit("."), "rule_host")))
        & F.col("path").startswith(F.col("rule_path"))
    )
    rule = F.when(fits, F.struct(
        F.length(F.concat("rule_host", "rule_path")).alias("long"),
        F.length("rule_host").alias("host_long"),
        F.concat("rule_host", "rule_path").alias("rule"),
        "verdict",
    ))
    best = exact.groupBy("page_id", "url").agg(
        F.max(rule).alias("best"), F.max(F.col("rule_host").isNull()).alias("is_listed")
    )
    best = best.select(F.col("page_id").alias("_page"), F.col("url").alias("_url"), "best", "is_listed")
    seen = F.coalesce("is_listed", F.lit(False))
    return narrow.join(
        best, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("url") == F.col("_url")), "left"
    ).select(
        "page_id",
        url_host(F.col("url")).alias("host"),
        url_path(F.col("url")).alias("path"),
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.when(seen, "block").otherwise("allow")).alias("verdict"),
        seen.alias("is_listed"),
    )

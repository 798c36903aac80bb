"""Secret scans over the history of files: every content is scanned once for every version of a rule.

A ledger holds the pairs of content and rule version that have been scanned. Contents are named by their
SHA-256, so copies, renames and reverts cost nothing, and a new rule version scans everything once more for
that rule alone. Findings belong to contents and are joined back to every path that ever held them. All of it is
DataFrame functions.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.operators.materialize import materialize


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds, leftmost and non-overlapping; a match stays if ``group`` has ``least`` characters.

    ``hint`` is a cheap condition without which no match is possible.
    """

    name: str
    version: int
    pattern: str
    group: int
    least: int
    hint: tuple[str, ...] | str

    @property
    def key(self) -> str:
        return f"{self.name}:{self.version}"

    def possible(self, text: Column) -> Column:
        if isinstance(self.hint, str):
            return text.rlike(self.hint)
        lower = F.lower(text)
        found = [lower.contains(word) for word in self.hint]
        return F.coalesce(*[F.when(c, True) for c in found], F.lit(False))


# The forms of common credentials.
BASE_RULES = (
    Rule(
        "assign", 1,
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 12, ("password", "passwd", "secret", "token", "apikey", "api_key"),
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18, "AKIA[A-Z0-9]{14}"),
    Rule("hex", 1, r"[0-9a-f]{16,}", 0, 16, "[0-9a-f]{16}"),
)
RULES = (
    *BASE_RULES,
    Rule("private_key", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, ("private key-----",)),
    Rule("web_token", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1, ("eyj",)),
)


def content_address(versions: DataFrame, text_column: str = "text") -> DataFrame:
    """``versions`` with the column ``blob``: the SHA-256 of the text; a null counts as empty."""
    return versions.withColumn("blob", F.sha2(F.coalesce(F.col(text_column).cast("string"), F.lit("")), 256))


def scan_history(
    versions: DataFrame,
    ledger: DataFrame | None = None,
    rules: tuple[Rule, ...] = RULES,
    text_column: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Findings (blob, rule, version, start, end) and new ledger rows (blob, rule, version).

    ``ledger`` (blob, rule, version) names what needs no scan. Offsets count code points, the end is
    exclusive. Null texts are empty and have no findings, but enter the ledger. Repeated texts are scanned
    once. Other columns of ``versions`` are not read. Empty tables give empty results.
    """
    narrow = versions.select(F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    blobs = content_address(narrow).groupBy("blob").agg(F.first("text").alias("text"))
    wanted = F.array(*[F.lit(rule.key) for rule in rules])
    if ledger is None:
        blobs = blobs.withColumn("todo", wanted)
    else:
        known = ledger.groupBy("blob").agg(F.collect_set(F.concat_ws(":", "rule", "version")).alias("known"))
        todo = F.array_except(wanted, F.coalesce("known", F.array().cast("array<string>")))
        blobs = blobs.join(known, "blob", "left").select("blob", "text", todo.alias("todo"))
        blobs = blobs.where(F.size("todo") > 0)

    text = F.col("text")

    def matches(rule: Rule) -> Column:
        found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
        value = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
        parts = F.struct(
            F.lit(rule.name).alias("rule"),
            F.lit(rule.version).alias("version"),
            F.lit(rule.least).alias("least"),
            # between two matches lies a piece of the split; the last one is of no use
            F.arrays_zip(
                F.transform(F.split(text, rule.pattern, -1), F.length).alias("gap"),
                F.transform(found, F.length).alias("long"),
                F.transform(value, F.length).alias("value"),
            ).alias("parts"),
        )
        return F.when(F.array_contains("todo", rule.key) & rule.possible(text), parts)

    by_rule = blobs.select("blob", F.explode(F.array(*[matches(rule) for rule in rules])).alias("m"))
    lengths = (
        by_rule.where("m is not null and size(m.parts) > 1")
        .select("blob", "m.rule", "m.version", "m.least", F.posexplode("m.parts").alias("at", "part"))
        .select("blob", "rule", "version", "least", "at", "part.*")
    )
    # a window holds the matches of one rule in one text
    window = Window.partitionBy("blob", "rule", "version").orderBy("at")
    end = F.sum(F.col("gap") + F.coalesce("long", F.lit(0))).over(window)
    findings = (
        lengths.withColumn("end", end)
        .where(F.col("value") >= F.col("least"))
        .select("blob", "rule", "version", (F.col("end") - F.col("long")).alias("start"), "end")
    )
    parsed = F.split("key", ":")
    scanned = blobs.select("blob", F.explode("todo").alias("key")).select(
        "blob", parsed[0].alias("rule"), parsed[1].cast("int").alias("version")
    )
    return findings, scanned


def findings_by_path(versions: DataFrame, findings: DataFrame, text_column: str = "text") -> DataFrame:
    """``versions`` with ``findings``: an array (start, rule, version, end), sorted; empty where nothing was found.

    One row for each row of ``versions``, also where many share a text. A finding that is given twice counts once.
    Columns that are named ``blob`` or ``findings`` are replaced.
    """
    # Written, so that the join has a shuffle on either side and the paths of a hot content can be split.
    per_blob = materialize(
        findings.groupBy("blob").agg(
            F.sort_array(F.collect_set(F.struct("start", "rule", "version", "end"))).alias("findings")
        )
    )
    none = F.array().cast("array<struct<start:bigint,rule:string,version:int,end:bigint>>")
    addressed = content_address(versions.drop("findings"), text_column)
    return addressed.join(per_blob, "blob", "left").withColumn("findings", F.coalesce("findings", none))


class SecretLedger:
    """A ledger and its findings in a folder that every executor can reach; each update adds what is new.

    An update writes its findings before its ledger rows, into folders of its own. One that dies in between is
    scanned again, and readers count equal findings once.
    """

    def __init__(self, spark, folder: str, rules: tuple[Rule, ...] = RULES):
        self.spark, self.folder, self.rules = spark, folder, rules

    def _read(self, name: str, schema: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        exists = hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop)
        if not exists:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)

    def scanned(self) -> DataFrame:
        return self._read("scanned", "blob string, rule string, version int").distinct()

    def findings(self) -> DataFrame:
        return self._read("findings", "blob string, rule string, version int, start long, end long").distinct()

    def update(self, versions: DataFrame, text_column: str = "text") -> None:
        findings, scanned = scan_history(versions, self.scanned(), self.rules, text_column)
        run = uuid.uuid4().hex
        findings.write.parquet(f"{self.folder}/findings/{run}")
        scanned.write.parquet(f"{self.folder}/scanned/{run}")

"""WARC archives and their index, merged from locally sorted runs.

Every task writes its records, sorted by URL key and time, as one archive, which is one run of the index. An archive is
stored in pieces, rows of a Parquet table below any folder that Spark reaches; its pieces one after the other are a
``.warc.gz`` file, and ``export_files`` writes them as such. Tasks that each own a range of keys merge the runs that reach into
their range with a loser tree, so the whole index is in order of URL key and time: the capture history of every
URL. Records are read back through the index and carry their place in it.
"""

from __future__ import annotations

import base64
import datetime
import gzip
import hashlib
import os
import urllib.parse
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.operators.materialize import checkpoint_root, materialize

ENTRIES_PER_RANGE = 200_000
PIECE_BYTES = 1 << 20
INDEX = ("urlkey", "at", "page_id", "run", "piece", "start", "size")
# The time of a capture, in seconds, where pages have none of their own: 2024-01-01.
CAPTURED = 1_704_067_200
# The seconds of the first and the last second that a date of a record can name.
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799
# The fields of a record and the profile of a revisit.
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def url_key(url: Column) -> Column:
    """Host labels in reverse order, a closing bracket and the rest: URLs of a domain stand together. Empty for null."""
    host = F.lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#:]*)", 1))
    rest = F.regexp_replace(F.regexp_extract(url, r"(?s)^.*?://[^/?#:]*([^#]*)", 1), r"[\r\n]", " ")
    labels = F.array_join(F.reverse(F.split(host, r"\.", -1)), ",")
    return F.coalesce(F.when(url.contains("://"), F.concat(labels, F.lit(")"), rest)).otherwise(url), F.lit(""))


def warc_date(seconds: int) -> str:
    """A date of the years 1 to 9999; times beyond them are the first or last second of those."""
    at = datetime.timedelta(seconds=min(max(seconds, FIRST_SECOND), LAST_SECOND))
    return (datetime.datetime(1970, 1, 1) + at).strftime("%Y-%m-%dT%H:%M:%SZ").rjust(20, "0")


def page_name(page_id) -> str:
    return "urn:null" if page_id is None else f"urn:page:{urllib.parse.quote(str(page_id), safe='')}"


def record(row: dict) -> bytes:
    """One record, uncompressed. A revisit has the HTTP head only and names the record that holds the payload."""
    payload = (row["html"] or "").encode()
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    fields = [
        ("WARC-Type", row["kind"]),
        ("WARC-Record-ID", f"<{page_name(row['page_id'])}>"),
        ("WARC-Date", warc_date(row["at"])),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if row["url"] is not None:
        fields.insert(2, ("WARC-Target-URI", row["url"].replace("\r", "%0D").replace("\n", "%0A")))
    block = HTTP_HEAD
    if row["kind"] == "revisit":
        fields += [("WARC-Refers-To", f"<{page_name(row['refers_to'])}>"), ("WARC-Profile", REVISIT)]
    else:
        block += payload
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def entry_type(id_type: pa.DataType) -> pa.DataType:
    return pa.struct([("urlkey", pa.string()), ("at", pa.int64()), ("page_id", id_type), ("start", pa.int64()), ("size", pa.int64())])


def write_run(id_type: pa.DataType, write: str):
    """The rows of a task, which come sorted, as the pieces of one archive of gzip members, with the entries of each.

    A piece has PIECE_BYTES, or one larger record. An attempt has a run of its own, so one that failed leaves nothing behind.
    """
    schema = pa.schema([("run", pa.string()), ("piece", pa.int32()), ("members", pa.binary()), ("entries", pa.list_(entry_type(id_type)))])

    def run(batches):
        name, piece, members, entries, size = f"{write}-{uuid.uuid4().hex}", 0, [], [], 0

        def closed():
            row = {"run": name, "piece": piece, "members": b"".join(members), "entries": entries}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    member = gzip.compress(record(row), 6, mtime=0)
                    if members and size + len(member) > PIECE_BYTES:
                        yield closed()
                        piece, members, entries, size = piece + 1, [], [], 0
                    entries.append({"urlkey": row["urlkey"], "at": row["at"], "page_id": row["page_id"], "start": size, "size": len(member)})
                    members.append(member)
                    size += len(member)
        if members:
            yield closed()

    return run


class LoserTree:
    """Merges k sorted runs: inner nodes keep the loser of their match, so the next winner takes log k comparisons."""

    def __init__(self, runs: list[Iterator], key):
        self.runs, self.key, self.k = runs, key, len(runs)
        self.heads = [next(run, None) for run in runs]
        self.losers = [-1] * max(1, self.k)
        for i in range(self.k):
            self._play(i)

    def _before(self, a: int, b: int) -> bool:
        if self.heads[a] is None or self.heads[b] is None:
            return self.heads[b] is None and (self.heads[a] is not None or a < b)
        x, y = self.key(self.heads[a]), self.key(self.heads[b])
        return (x, a) < (y, b)

    def _play(self, winner: int) -> None:
        node = (winner + self.k) // 2
        while node > 0:
            if self.losers[node] < 0:  # nobody has come here yet: wait for an opponent
                self.losers[node] = winner
                return
            if self._before(self.losers[node], winner):
                winner, self.losers[node] = self.losers[node], winner
            node //= 2
        self.losers[0] = winner

    def __iter__(self):
        if not self.k:
            return
        while self.heads[self.losers[0]] is not None:
            winner = self.losers[0]
            yield self.heads[winner]
            self.heads[winner] = next(self.runs[winner], None)
            self._play(winner)


def entry_key(entry: tuple):
    """URL key by code point, then time, then page, null first, then where it lies."""
    key, at, page, run, piece, start, _ = entry
    return key.encode(), at, page is not None, page.encode() if isinstance(page, str) else page or 0, run, piece, start


def merge_range(batches):
    """The runs' parts of one key range, run after run and each in order, merged into one; a range is of bounded size."""
    runs: dict[str, list[tuple]] = {}
    schema = None
    for batch in batches:
        schema = batch.schema
        for entry in zip(*(batch.column(i).to_pylist() for i in range(len(INDEX))), strict=True):
            runs.setdefault(entry[3], []).append(entry)
    merged, place = [], 0
    for entry in LoserTree([iter(r) for r in runs.values()], entry_key):
        merged.append(entry)
        if len(merged) == 10_000:
            yield numbered_entries(merged, place, schema)
            place, merged = place + len(merged), []
    if merged:
        yield numbered_entries(merged, place, schema)


def numbered_entries(entries: list[tuple], place: int, schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*entries, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(
        [*columns, pa.array(range(place, place + len(entries)), pa.int64())], names=[*schema.names, "place"]
    )


def write_archives(pages: DataFrame, folder: str, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", time_column: str | None = None) -> DataFrame:
    """Writes ``pages`` as archives into a new folder below ``folder`` and returns the merged index: INDEX, range and place.

    Of pages with equal payloads that with the largest id is a response and the others revisit it. A null html is an empty
    payload. Pages that share the largest id are all responses, and so are pages of which none has an id. A null URL has no target and an empty
    key. The time of a page is in ``time_column``, in seconds; without it, and where it is null, it is CAPTURED. Whole numbers stay
    whole as ids; ids of any other type are text, by code point. Other columns are not read. Ordered by range and place, the index is in order of
    URL key, time and id.
    """
    whole = isinstance(pages.schema[id_column].dataType, T.IntegralType)
    page_id = F.col(id_column).cast("long" if whole else "string")
    at = F.lit(CAPTURED).cast("long")
    if time_column:
        at = F.coalesce(F.col(time_column).cast("long"), at)
    rows = pages.select(
        page_id.alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        F.coalesce(F.col(html_column).cast("string"), F.lit("")).alias("html"),
        at.alias("at"),
        url_key(F.col(url_column).cast("string")).alias("urlkey"),
    )
    payload = [F.sha1("html").alias("digest"), F.octet_length("html").alias("length")]
    # Written, so that the join has a shuffle on either side and the pages of a hot payload can be split.
    holders = materialize(
        rows.select("page_id", *payload).groupBy("digest", "length").agg(F.max("page_id").alias("holder"))
    )
    marked = rows.select("*", *payload).join(holders, ["digest", "length"])
    revisit = F.col("holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("holder"))
    write = uuid.uuid4().hex
    entry = f"struct<urlkey:string,at:long,page_id:{'long' if whole else 'string'},start:long,size:long>"
    archives = (
        marked.select(
            "page_id", "url", "html", "at", "urlkey",
            F.when(revisit, "revisit").otherwise("response").alias("kind"),
            F.when(revisit, F.col("holder")).alias("refers_to"),
        )
        .sortWithinPartitions("urlkey", "at", F.asc_nulls_first("page_id"))
        .mapInArrow(write_run(pa.int64() if whole else pa.string(), write), f"run string, piece int, members binary, entries array<{entry}>")
    )
    archives.write.parquet(f"{folder}/{write}")
    written = pages.sparkSession.read.schema(archives.schema).parquet(f"{folder}/{write}")
    return merge_index(written.select("run", "piece", F.inline("entries")).select(*INDEX))


def merge_index(entries: DataFrame) -> DataFrame:
    """(INDEX, range, place) in order of URL key, time and id, from sorted runs.

    Ranges are cut by all of that and by where a record lies, so many captures of one URL, with or without ids, have many ranges.
    """
    parts = -(-entries.count() // ENTRIES_PER_RANGE) or 1
    merged = (
        entries.repartitionByRange(parts, "urlkey", "at", "page_id", "run", "piece", "start")
        .sortWithinPartitions("run", "urlkey", "at", F.asc_nulls_first("page_id"), "piece", "start")
        .mapInArrow(merge_range, T.StructType([*entries.schema.fields, T.StructField("place", T.LongType())]))
    )
    return materialize(merged.withColumn("range", F.spark_partition_id()))


def parse(member: bytes) -> dict:
    """Fields and payload of one record; raises where lengths or digest do not hold."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if not version.startswith("WARC/") or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    payload = block.partition(b"\r\n\r\n")[2]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and digest != base64.b32encode(hashlib.sha1(payload).digest()).decode():
        raise ValueError("payload and digest differ")

    def page(name: str) -> str | None:
        value = fields.get(name, "").removeprefix("<").removesuffix(">")
        return urllib.parse.unquote(value.removeprefix("urn:page:")) if value.startswith("urn:page:") else None

    return {
        "page_id": page("WARC-Record-ID"),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": int(fields["WARC-Payload-Length"]),
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": page("WARC-Refers-To"),
        "html": payload.decode() if fields["WARC-Type"] == "response" else None,
    }


def read_archives(index: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """The records that ``index`` names, parsed and checked; a piece of an archive is held at a time.

    Columns: page_id, url, payload_bytes, payload_digest, record_type, refers_to, html if asked for (null for revisits), and range and
    place: sorted by both, the records are capture histories in the order of the index. Archives are read where they lie, each piece with
    the entries that are stored beside it; what is shuffled to meet the index is the parsed records.
    """
    kinds = {"page_id": "string", "url": "string", "payload_bytes": "long", "payload_digest": "string", "record_type": "string", "refers_to": "string"}
    kinds |= {"html": "string"} if payload else {}
    places = {"run": "string", "piece": "int", "start": "long"}
    arrow = {"long": pa.int64(), "string": pa.string(), "int": pa.int32()}

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                members = batch.column("members")[row].as_py()
                run_, piece, found = (batch.column(c)[row].as_py() for c in ("run", "piece", "found"))
                for at in range(0, len(found), 256):
                    records = [
                        parse(members[f["start"] : f["start"] + f["size"]]) | {"run": run_, "piece": piece, "start": f["start"]}
                        for f in found[at : at + 256]
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[c] for r in records], arrow[t]) for c, t in (kinds | places).items()], names=[*kinds, *places]
                    )

    stored = "run string, piece int, members binary, entries array<struct<start:long,size:long>>"
    writes = [r[0] for r in index.select(F.substring_index("run", "-", 1)).distinct().collect()]  # of one index: one
    if not writes:
        return index.sparkSession.createDataFrame([], ", ".join(f"{c} {t}" for c, t in (kinds | {"range": "int", "place": "long"}).items()))
    archives = index.sparkSession.read.schema(stored).parquet(*[f"{folder}/{w}" for w in writes]).select("run", "piece", "members", F.col("entries").alias("found"))
    records = archives.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in (kinds | places).items()))
    ids = index.schema["page_id"].dataType
    named = index.select("run", "piece", "start", "range", "place")
    records = records.withColumns({c: F.col(c).cast(ids) for c in ("page_id", "refers_to")})
    return records.join(named, ["run", "piece", "start"]).select(*kinds, "range", "place")


def export_files(spark, folder: str, target: str) -> DataFrame:
    """Write the archives below ``folder`` as files ``<run>.warc.gz`` in ``target``, a folder that every worker has mounted.

    Returns run and bytes of each. A run is written by one task, piece after piece, and gets its name when it is whole.
    """

    def run(batches):
        name, file, size = None, None, 0

        def done():
            file.close()
            os.replace(file.name, f"{target}/{name}.warc.gz")
            return pa.RecordBatch.from_arrays([pa.array([name], pa.string()), pa.array([size], pa.int64())], names=["run", "bytes"])

        for batch in batches:
            for own, members in zip(batch.column("run").to_pylist(), batch.column("members"), strict=True):
                if own != name:
                    if file is not None:
                        yield done()
                    name, size = own, 0
                    file = open(f"{target}/.{own}-{uuid.uuid4().hex}", "wb")  # noqa: SIM115
                size += file.write(members.as_py())
        if file is not None:
            yield done()

    archives = spark.read.schema("run string, piece int, members binary").option("recursiveFileLookup", True).parquet(folder)
    return materialize(archives.repartition("run").sortWithinPartitions("run", "piece").mapInArrow(run, "run string, bytes long"))


def archive_folder(spark) -> str:
    """A new folder below the shared one."""
    return f"{checkpoint_root(spark)}/warc-{uuid.uuid4().hex}"

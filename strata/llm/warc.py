"""WARC archives and their capture index.

:func:`write_warc` writes one record per page with Spark's text writer: a record is its header,
a blank line and the payload, and the record separator is the writer's line separator, so every file
is a gzip WARC file on the cluster's file system. Of records with equal payloads of at least
``REVISIT_BYTES`` bytes, the one with the largest ``page_id`` is the response and the others are revisits
of it, which hold the payload's length in place of the payload.

:func:`read_warc` reads the archives back (each gzip file as one stream of lines, put together
again by the record's Content-Length) into index entries. Each task sorts its entries by
(URL key, time, id) into runs of at most ``RUN`` entries. :func:`merged_index` deals the runs'
entries by ranges of that key (about ``RANGE`` entries each at most) and merges the runs of each range with a k-way loser tree;
ranges in order give the globally ordered capture histories. A URL captured very often is
split over ranges by time and id.

Defined cases: null html is an empty payload; a null url is left out of the header and has the
empty URL key; a null ``page_id`` is never a revisit nor the response of one; rows that repeat the
response's ``page_id`` are responses too; line breaks in a url are percent-encoded; other columns
are ignored; without pages there are no records.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import by_key, scratch_path, stored

REVISIT_BYTES = 1000
RUN = 50_000
#: Capture times start here (the pages have none) and follow the page ids by the second.
FIRST_CAPTURE = "2024-01-01 00:00:00"
_CRLF = "\r\n"
#: Header of a revisit with the length of the payload that it does not repeat.
_FULL_LENGTH = "X-Payload-Length"
#: Index entries that one task should merge.
RANGE = 500_000


def captures(pages: DataFrame) -> DataFrame:
    """``pages`` with payload, digest, record type and the response that a revisit refers to."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1(F.encode("payload", "utf-8"))).withColumn("n", F.octet_length("payload"))
    groups = rows.where(F.col("n") >= REVISIT_BYTES).groupBy("digest").agg(
        F.max("page_id").alias("response"), F.min("page_id").alias("least"))
    groups = stored(groups.where("response <> least").select(F.col("digest").alias("key"), "response"), "warc-groups")
    joined = rows.join(groups, F.col("digest") == F.col("key"), "left")
    return joined.select("page_id", "url", "payload", "n", "digest", F.when(F.col("page_id") < F.col("response"), F.col("response")).alias("refers_to"))


def write_warc(pages: DataFrame, path: str) -> None:
    """Write one record per page below ``path``."""
    url = F.regexp_replace(F.regexp_replace(F.col("url"), "\r", "%0D"), "\n", "%0A")
    seconds = F.unix_timestamp(F.lit(FIRST_CAPTURE)) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10**9))
    when = F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    revisit = F.col("refers_to").isNotNull()
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(_CRLF))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    header = F.concat(
        F.lit("WARC/1.1" + _CRLF),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn(F.col("page_id"))),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        line("WARC-Date", when),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, line("WARC-Refers-To", urn(F.col("refers_to")))).otherwise(F.lit("")),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" + _CRLF)).otherwise(F.lit("")),
        F.when(revisit, line(_FULL_LENGTH, F.col("n").cast("string"))).otherwise(F.lit("")),
        F.lit("Content-Type: text/html" + _CRLF),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("n")).cast("string")),
        F.lit(_CRLF),
    )
    record = F.concat(header, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    captures(pages).select(record.alias("value")).write.option("compression", "gzip").option("lineSep", _CRLF + _CRLF).text(path)


def url_key(url: str) -> str:
    """The URL with its host's labels reversed, lower-cased, without scheme, port and fragment."""
    m = re.match(r"[^:/?#]*://(?:[^@/?#]*@)?([^/?#:]*)(?::\d*)?([^#]*)", url, re.S)
    if not m:
        return url.lower()
    return ",".join(reversed(m[1].lower().split("."))) + ")" + (m[2].lower() or "/")


def records(lines: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, payload) of every record in a stream of lines cut at CR LF."""
    for line in lines:
        if not line:
            continue  # the blank line after a record
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        fields = {}
        for line in lines:
            if not line:
                break
            name, _, value = line.decode().partition(": ")
            fields[name] = value
        length, parts, size = int(fields["Content-Length"]), [], -2
        while size < length:
            parts.append(next(lines))
            size += 2 + len(parts[-1])
        if size != length:
            raise ValueError(f"a payload of {size} bytes where {length} are announced")
        yield fields, b"\r\n".join(parts)


_ENTRY = """run long, url_key string, warc_date string, page_id long, record_type string, refers_to long,
payload_bytes long, payload_digest string"""
_FIELDS = ["url_key", "warc_date", "page_id", "record_type", "refers_to", "payload_bytes", "payload_digest"]


def _id(urn: str | None) -> int | None:
    text = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def _order(entry: tuple) -> tuple:
    """Sort key (URL key, time, id; a null id first)."""
    return entry[0], entry[1], -(1 << 63) if entry[2] is None else entry[2]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run = TaskContext.get().partitionId() << 32
    held: list[tuple] = []

    def out() -> pa.RecordBatch:
        held.sort(key=_order)
        columns = [np.full(len(held), run), *zip(*held, strict=True)]
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["run", *_FIELDS])

    lines = (x for batch in batches for x in batch.column("value").cast(pa.binary()).to_pylist())
    for fields, payload in records(lines):
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = fields["WARC-Type"]
        if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError("a payload does not have its digest")
        held.append((url_key(fields.get("WARC-Target-URI", "")), fields["WARC-Date"], _id(fields["WARC-Record-ID"]), kind,
                     _id(fields.get("WARC-Refers-To")), len(payload) if kind == "response" else int(fields[_FULL_LENGTH]), digest))
        if len(held) >= RUN:
            yield out()
            held, run = [], run + 1
    if held:
        yield out()


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of all records below ``path``, as sorted runs (a revisit has the length of its response's payload)."""
    lines = spark.read.option("lineSep", _CRLF).text(path)
    return stored(lines.mapInArrow(_runs, _ENTRY), "warc-runs")


class LoserTree:
    """k-way merge of sorted runs: an inner node keeps the loser of its match, the winner goes up."""

    def __init__(self, runs: list[list]) -> None:
        self.runs, self.at, self.k = runs, [0] * len(runs), len(runs)
        self.tree = [-1] * max(1, self.k)
        for leaf in range(self.k):
            self._play(leaf)

    def _beats(self, a: int, b: int) -> bool:
        """Whether run ``a``'s head goes before run ``b``'s (an empty run loses; equal heads by run)."""
        end_a, end_b = self.at[a] >= len(self.runs[a]), self.at[b] >= len(self.runs[b])
        if end_a or end_b:
            return end_b and not (end_a and a > b)
        x, y = self.runs[a][self.at[a]], self.runs[b][self.at[b]]
        return x < y or (x == y and a < b)

    def _play(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            other = self.tree[node]
            if other < 0:
                self.tree[node] = winner
                return
            if self._beats(other, winner):
                self.tree[node], winner = winner, other
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """(run, position) in merged order."""
        for _ in range(sum(map(len, self.runs))):
            run = self.tree[0]
            yield run, self.at[run]
            self.at[run] += 1
            self._play(run)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables = list(by_key(batches, ["run"]))
    if not tables:
        return
    runs = [[_order(e) for e in zip(*(t[c].to_pylist() for c in _FIELDS[:3]), strict=True)] for t in tables]
    start = np.cumsum([0, *map(len, runs)])
    order = [int(start[r]) + p for r, p in LoserTree(runs)]
    yield from pa.concat_tables(tables).select(_FIELDS).take(pa.array(order)).combine_chunks().to_batches(max_chunksize=10_000)


def merged_index(entries: DataFrame) -> DataFrame:
    """All entries in the order of (URL key, time, id), by range and within it."""
    parts = max(int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-entries.count() // RANGE))
    key = ["url_key", "warc_date", "page_id"]
    ranges = entries.repartitionByRange(parts, *key).sortWithinPartitions("run", *key)
    return ranges.mapInArrow(_merged, _ENTRY.split(", ", 1)[1])


def archive(pages: DataFrame) -> DataFrame:
    """Write the pages to archives below the checkpoint folder, read them back and merge their index."""
    path = scratch_path(pages.sparkSession, "warc")
    write_warc(pages, path)
    return merged_index(read_warc(pages.sparkSession, path))

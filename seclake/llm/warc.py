"""WARC archives of pages and a globally ordered index of their captures.

Writing. Every page becomes one record. Of pages with equal payloads the
one with the smallest id is a ``response`` with the payload in its block; the
others are ``revisit`` records that refer to it. Archives are plain WARC/1.1
files, written by Spark's text writer with the record end as line separator:
page text is UTF-8, and so are the headers. A file holds at most ``RECORDS``
records and is compressed as a whole; offsets in the index are those of the
uncompressed archive.

Reading. Each archive is parsed by its Content-Length headers, its payloads'
digests are recomputed and held against the headers, and its captures, sorted
by (URL key, time, id), leave as one *run*: the file's locally sorted index.

Merging. The runs are dealt to ranges of (URL key, time, id), whose bounds Spark
samples; as the bounds have all three parts, one URL with very many captures
is dealt over several ranges. In a range the sorted pieces of all runs meet in
a loser tree, which gives the captures in global order and, by the range's
number and the place in it, their ``position`` in the whole index.

Null html is an empty payload. Repeated rows are records of their own, all of
them responses if they have the smallest id. A null id is a revisit of any
other id's page; if all ids are null, all are responses. A null URL has the empty key.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import parse_qsl, unquote, urlencode, urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seclake.llm.common import batches
from seclake.session import checkpoint_dir, materialize, partitions_for

RECORDS = 2000
CRLF = "\r\n"
END = CRLF + CRLF
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIRST_CAPTURE = 1_700_000_000  # seconds; pages carry no time of their own
INDEX = pa.schema([("url_key", pa.string()), ("captured", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                   ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
INDEX_DDL = ("url_key string, captured long, page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
             "refers_to long, archive string, offset long, length long")


def url_key(url: str | None) -> str:
    """Host labels from the top, then path and sorted query, in lower case, without scheme, port, user and fragment."""
    try:
        parts = urlsplit((url or "").strip())
        host = parts.hostname or ""
    except ValueError:
        return (url or "").strip().lower()
    if not host:
        return (url or "").strip().lower()
    labels = host.split(".")
    if labels[0] == "www" and len(labels) > 2:
        labels = labels[1:]
    query = urlencode(sorted(parse_qsl(parts.query, keep_blank_values=True)))
    return f"{','.join(reversed(labels))}){unquote(parts.path).rstrip('/') or '/'}{'?' + query if query else ''}".lower()


def base32_of_hex(digest: Column) -> Column:
    def run(x: pd.Series) -> pd.Series:
        return x.map(lambda h: base64.b32encode(bytes.fromhex(h)).decode(), na_action="ignore")
    return F.pandas_udf(run, "string")(digest)


def decided(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``pages(page_id, url, html)`` with ``payload, payload_bytes, sha1, record_type, refers_to``."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "sha1": F.sha1(F.col("payload").cast("binary"))})
    first = rows.where(F.col("payload_bytes") >= least_bytes).groupBy("sha1", "payload_bytes").agg(F.min("page_id").alias("first_id"))
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return (rows.join(first, ["sha1", "payload_bytes"], "left")
            .withColumns({"record_type": F.when(revisit, "revisit").otherwise("response"), "refers_to": F.when(revisit, F.col("first_id"))})
            .drop("first_id"))


def write_archives(rows: DataFrame, path: str, first_capture: int = FIRST_CAPTURE) -> None:
    """One WARC record per row of ``decided`` pages, in files under ``path``."""
    def uri(name: str) -> Column:
        return F.regexp_replace(F.coalesce(F.col(name), F.lit("")), r"[\r\n]", " ")

    def record_id(name: str) -> Column:
        return F.coalesce(F.concat(F.lit("<urn:page:"), F.col(name).cast("string"), F.lit(">")), F.lit("<urn:page:none>"))

    seconds = F.lit(first_capture) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10 ** 8))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    revisit = F.col("record_type") == "revisit"
    rows = rows.withColumns({"http": http, "digest": base32_of_hex(F.col("sha1"))})
    block = F.octet_length("http") + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    head = F.concat_ws(
        CRLF, F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), "record_type"), F.concat(F.lit("WARC-Record-ID: "), record_id("page_id")),
        F.concat(F.lit("WARC-Date: "), F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.concat(F.lit("WARC-Target-URI: "), uri("url")), F.concat(F.lit("WARC-Payload-Digest: sha1:"), "digest"),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}{CRLF}WARC-Refers-To: "), record_id("refers_to"))),
        F.lit("Content-Type: application/http; msgtype=response"), F.concat(F.lit("Content-Length: "), block.cast("string")))
    record = F.concat(head, F.lit(END), F.col("http"), F.when(revisit, "").otherwise(F.col("payload")))
    rows.select(record.alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", RECORDS).option("compression", "gzip").text(path)


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes, int, int]]:
    """(headers, block, offset, length) of each record."""
    at = 0
    while at < len(archive):
        end = archive.index(b"\r\n\r\n", at)
        lines = archive[at:end].decode().split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        stop = end + 4 + int(headers["Content-Length"])
        if archive[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} doesn't end where it says")
        yield headers, archive[end + 4:stop], at, stop + 4 - at
        at = stop + 4


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """The captures in the archives under ``path``; those of a file are sorted by (url_key, captured, page_id)."""
    def page(uri: str) -> int | None:
        name = uri.removeprefix("<urn:page:").removesuffix(">")
        return None if name == "none" else int(name)

    def captures(name: str, archive: bytes) -> list[tuple]:
        out = []
        for headers, block, offset, length in parse(gzip.decompress(archive)):
            http, _, payload = block.partition(b"\r\n\r\n")
            size = int(http.rpartition(b"Content-Length: ")[2])
            digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
            kind = headers["WARC-Type"]
            if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                raise ValueError(f"{name}: the payload at byte {offset} isn't what its headers say")
            seconds = int(pd.Timestamp(headers["WARC-Date"]).timestamp())
            refers = page(headers["WARC-Refers-To"]) if kind == "revisit" else None
            url = headers["WARC-Target-URI"]
            out.append((url_key(url), seconds, page(headers["WARC-Record-ID"]), url, kind, size, digest, refers, name, offset, length))
        return sorted(out, key=capture_order)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in it:
                for k in range(batch.num_rows):
                    yield from captures(batch.column(0)[k].as_py().rpartition("/")[2], batch.column(1)[k].as_py())
        yield from batches(rows(), INDEX)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, INDEX_DDL)


def capture_order(row: tuple) -> tuple:
    return row[0].encode(), row[1], row[2] is not None, row[2] or 0, row[8], row[9]


class LoserTree:
    """Merges sorted lists. Each inner node holds the loser of the match below
    it, so that a new head plays one match per level only."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key, self.k = [iter(r) for r in runs], key, max(1, len(runs))
        self.heads = [next(r, None) for r in self.runs] + [None] * (self.k - len(runs))
        self.keys = [None if h is None else key(h) for h in self.heads]
        self.losers = [-1] * self.k
        winners = [-1] * self.k + list(range(self.k))
        for node in range(self.k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        self.winner = winners[1] if self.k > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[b] is None
        return (self.keys[a], a) < (self.keys[b], b)

    def __iter__(self):
        while self.heads[self.winner] is not None:
            at = self.winner
            yield self.heads[at]
            self.heads[at] = next(self.runs[at], None)
            self.keys[at] = None if self.heads[at] is None else self.key(self.heads[at])
            node = (at + self.k) // 2
            while node:
                if self._before(self.losers[node], at):
                    self.losers[node], at = at, self.losers[node]
                node //= 2
            self.winner = at


def merge_runs(captures: DataFrame) -> DataFrame:
    """All captures with ``position``, which rises in the order of (url_key, captured, page_id)."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, list[tuple]] = {}
        for batch in it:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                runs.setdefault(row[8], []).append(row)
        for rows in runs.values():  # pieces of a run may arrive in any order; each is sorted, so this is a short merge
            rows.sort(key=capture_order)
        yield from batches(LoserTree(list(runs.values()), capture_order), INDEX)

    ranges = captures.repartitionByRange(partitions_for(captures), "url_key", "captured", "page_id", "archive", "offset")
    return ranges.mapInArrow(run, INDEX_DDL).withColumn("position", F.monotonically_increasing_id())


def archive(pages: DataFrame, path: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Writes ``pages`` to archives (under ``path``, or a new folder in the checkpoint folder), reads them back and returns the merged index."""
    spark = pages.sparkSession
    path = path or f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(decided(pages, least_bytes), path)
    return merge_runs(materialize(read_captures(spark, path), "captures"))

"""WARC archives of pages, and one ordered index of all captures by external merge.

Writing. One record per page: ``response`` with the page's bytes, or ``revisit`` for a payload of at
least ``LEAST`` bytes that another page's response holds (of equal payloads, the one with the greatest
id). Records are text, so Spark's text writer lays them end to end, with the two line breaks that end a
record as its separator. Files are compressed, and bounded by bytes: within a task, records go to the next file
once the present one holds ``FILE_BYTES``, so that no file has more than that and one record. ``offset`` in the
index counts bytes of the file as unpacked.

Reading. Every file is parsed by the lengths its headers give; payload digests are computed anew and
compared with the headers. The entries of one file, sorted by URL key, time and id, are a run.

Merging. Runs are cut at common key ranges. In each range a loser tree merges the pieces of all runs
that reach into it, so the ranges in order are the capture histories of all URLs in order.

Defined results: NULL html is an empty payload, NULL URL an empty one; line breaks in URLs are written
as %0D and %0A; a NULL id is written empty and counts as the smallest; rows of one id and payload are
records of their own and of one kind; pages without a time get one from their id; an empty table gives
no rows.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekmeter.llm.common import cut, from_key, id_key, read, remove, shared_path

LEAST = 1000
FILE_BYTES = 16 << 20  # payload of one file, about
RANGE_ROWS = 200_000  # index entries merged by one task, about
FIRST_CAPTURE = 1_704_067_200  # 2024-01-01

# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BREAK = "\r\n"
RECORD_END = "\r\n\r\n"


def _page_uri(number: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(from_key(number).cast("string"), F.lit("")), F.lit(">"))


def records(pages: DataFrame) -> DataFrame:
    """One column: the whole record of each page, without the line breaks that end it."""
    time = F.col("captured_at") if "captured_at" in pages.columns else F.lit(None).cast("timestamp")
    keyed = pages.select(
        id_key(F.col("page_id").cast("long")).alias("id"),
        F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")).alias("url"),
        time.alias("at"),
        F.coalesce("html", F.lit("")).alias("html"),
    ).withColumn("key", F.sha2("html", 256))
    # Which response a payload has is found on ids and digests alone.
    small = keyed.select("id", "key", F.octet_length("html").alias("size")).where(F.col("size") >= LEAST)
    kept = small.groupBy("key").agg(F.max("id").alias("response"))
    revisits = small.join(kept, "key").where("id <> response").select("id", "key", "response").distinct()
    decided = keyed.join(revisits, ["id", "key"], "left")

    is_revisit = F.col("response").isNotNull()
    moment = F.coalesce("at", F.timestamp_seconds(FIRST_CAPTURE + F.pmod(F.col("id"), F.lit(1_000_000_000))))
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "),
        F.octet_length("html").cast("string"), F.lit(RECORD_END),
    )
    block = F.when(is_revisit, head).otherwise(F.concat(head, "html"))
    fields = [
        ("WARC-Type", F.when(is_revisit, "revisit").otherwise("response")),
        ("WARC-Record-ID", _page_uri("id")),
        ("WARC-Target-URI", F.col("url")),
        ("WARC-Date", F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1("html"))),
        ("Content-Type", F.lit("application/http;msgtype=response")),
    ]
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit(BREAK)) for name, value in fields]
    refers = F.when(
        is_revisit,
        F.concat(F.lit(f"WARC-Profile: {PROFILE}{BREAK}WARC-Refers-To: "), _page_uri("response"), F.lit(BREAK)),
    ).otherwise("")
    length = F.concat(F.lit("Content-Length: "), F.octet_length("_block").cast("string"), F.lit(RECORD_END))
    return decided.withColumn("_block", block).select(
        F.concat(F.lit(VERSION + BREAK), *lines, refers, length, "_block").alias("value")
    )


def write_archives(pages: DataFrame, path: str) -> None:
    """Write the records of all pages as compressed archives, each of ``FILE_BYTES`` and a record at most."""
    limit = FILE_BYTES

    @F.pandas_udf("int")
    def archive(sizes: Iterator[pd.Series]) -> Iterator[pd.Series]:
        before = 0  # bytes of the task's earlier records; only sizes go to Python
        for batch in sizes:
            ends = before + batch.cumsum()
            yield ((ends - batch) // limit).astype("int32")
            before = int(ends.max()) if len(ends) else before

    size = F.octet_length("value") + F.lit(len(RECORD_END)).cast("long")
    (
        records(pages).withColumn("archive", archive.asNondeterministic()(size))
        .write.partitionBy("archive").option("lineSep", RECORD_END).option("compression", "gzip").text(path)
    )


def url_key(url: str) -> str:
    """Host reversed by its dots, then the path and the query: pages of a site sort together."""
    _, found, rest = url.partition("://")
    rest = (rest if found else url).partition("#")[0]
    cut_at = min((k for k in (rest.find("/"), rest.find("?")) if k >= 0), default=len(rest))
    host, path = rest[:cut_at].lower(), rest[cut_at:]
    return ",".join(reversed(host.split("."))) + ")" + path


def parse_archive(data: bytes) -> Iterator[tuple]:
    """The records of one archive: key, time, id, url, kind, payload bytes and digest, id referred to, offset."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split(BREAK)
        if first != VERSION:
            raise ValueError(f"no record at byte {at}")
        field = dict(line.split(": ", 1) for line in lines)
        start = end + 4
        stop = start + int(field["Content-Length"])
        body = data.index(b"\r\n\r\n", start) + 4
        size = int(data[start:body].split(b"Content-Length: ", 1)[1].split(b"\r\n", 1)[0])
        digest = field["WARC-Payload-Digest"].removeprefix("sha1:")
        if field["WARC-Type"] == "response":
            payload = memoryview(data)[body:stop]
            if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
                raise ValueError(f"payload at byte {body} does not match its record")
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"no end of record at byte {stop}")
        url = field["WARC-Target-URI"]
        yield (
            url_key(url), field["WARC-Date"], _page_number(field["WARC-Record-ID"]), url, field["WARC-Type"],
            size, digest, _page_number(field.get("WARC-Refers-To", "")), at,
        )
        at = stop + 4


def _page_number(uri: str) -> int | None:
    number = uri.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


ENTRY = (
    "url_key string, captured_at string, page_id long, url string, record_type string, "
    "payload_bytes long, payload_digest string, refers_to long, offset long, file string"
)
_KINDS = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]


def _order(entry: tuple) -> tuple:
    """What runs are sorted by: key, time, id (NULL first); then where the record is."""
    return entry[0].encode(), entry[1], entry[2] is not None, entry[2] or 0, entry[9], entry[8]


def _entries(rows: list[tuple], more: list = ()) -> pa.RecordBatch:
    names = [x.split()[0] for x in ENTRY.split(", ")]
    columns = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), _KINDS, strict=True)]
    return pa.RecordBatch.from_arrays(columns + [x for _, x in more], names + [x for x, _ in more])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The entries of all archives under a path; those of a file are sorted, and numbered by ``seq``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = content.as_py()
                if data[:2] == b"\x1f\x8b":
                    data = gzip.decompress(data)
                name = "/".join(name.rsplit("/", 2)[-2:])  # a task's files differ by their folder only
                rows = sorted(((*entry, name) for entry in parse_archive(data)), key=_order)
                if rows:
                    yield _entries(rows, [("seq", pa.array(range(len(rows)), pa.int64()))])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, ENTRY + ", seq long")


class LoserTree:
    """Merges sorted runs: each inner node holds the run that lost there, the winner is on top."""

    def __init__(self, runs: list[Iterator], key):
        self.key = key
        self.runs = runs
        self.heads: list = []
        self.keys: list = []
        for run in runs:
            head = next(run, None)
            self.heads.append(head)
            self.keys.append(None if head is None else key(head))
        self.losers = [-1] * len(runs)
        for leaf in range(len(runs)):
            self._play(leaf)

    def _beats(self, a: int, b: int) -> bool:
        """A run at its end loses; equal keys go by run."""
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[b] is None and (self.keys[a] is not None or a < b)
        return (self.keys[a], a) < (self.keys[b], b)

    def _play(self, winner: int) -> None:
        """Let a run play its way up; where nobody has played yet it waits."""
        node = (winner + len(self.runs)) // 2
        while node > 0:
            other = self.losers[node]
            if other < 0:
                self.losers[node] = winner
                return
            if self._beats(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self):
        while self.runs:
            winner = self.losers[0]
            if self.heads[winner] is None:
                return
            yield self.heads[winner]
            head = next(self.runs[winner], None)
            self.heads[winner] = head
            self.keys[winner] = None if head is None else self.key(head)
            self._play(winner)


def merge_index(entries: DataFrame) -> DataFrame:
    """The entries of all runs in one order: partition by partition, row by row."""
    rows = entries.count()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: list[list[tuple]] = []
        last = None
        for batch in batches:
            for entry in zip(*(column.to_pylist() for column in batch.columns[:10]), strict=True):
                if entry[9] != last:
                    pieces.append([])
                    last = entry[9]
                pieces[-1].append(entry)
        out = []
        for entry in LoserTree([iter(piece) for piece in pieces], _order):
            out.append(entry)
            if len(out) >= 10_000:
                yield _entries(out)
                out = []
        if out:
            yield _entries(out)

    ranges = entries.repartitionByRange(
        max(1, -(-rows // RANGE_ROWS)), "url_key", "captured_at", F.col("page_id").asc_nulls_first(), "file", "offset"
    )
    return ranges.sortWithinPartitions("file", "seq").mapInArrow(run, ENTRY)


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_path(spark)}/warc-{uuid.uuid4().hex}"
    try:
        write_archives(read(spark, folder, "pages").select("page_id", "url", "html"), path)
        entries = cut(read_archives(spark, path))
    finally:
        remove(spark, path)
    return merge_index(entries).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

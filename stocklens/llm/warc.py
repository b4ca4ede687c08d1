"""WARC archives of pages, and their capture index merged from sorted runs.

Writing: a page is a response record, or a revisit record without payload where an earlier
page has the same payload. Records leave through Spark's text writer, whose line
separator is the blank lines that end a record, so the files are WARC 1.1, each compressed as a whole, on any
storage Spark writes to; offsets are of the uncompressed archive. Reading: each archive file is read whole, records are cut out by Content-Length, and the
entries of a file, sorted by (url key, time, page), are one run. Entries are dealt by range of
that key; in every range a loser tree merges the runs, so the index is in one global order.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklens.llm.shared import texts_of
from stocklens.sources.sinks import scratch_dir

END = "\r\n\r\n"
CAPTURED = "2024-01-01T00:00:00Z"
INDEX = (
    "url_key string, captured string, page_id long, run string, offset long,"
    " payload_bytes long, payload_digest string, record_type string, refers_to long"
)


def first_captures(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(digest, first): for each payload of ``min_bytes`` at least its smallest page_id."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    return (
        pages.filter(F.octet_length(payload) >= min_bytes)
        .select("page_id", F.sha1(payload).alias("digest"))
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("digest", "first")
    )


def write_archives(pages: DataFrame, path: str, *, min_bytes: int = 0, file_records: int = 4000) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) below ``path``.

    Null html is an empty payload. Only digests meet in a join, where few repeat.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        "page_id", F.coalesce("url", F.lit("")).alias("url"), payload.alias("html"),
        F.sha1(payload.cast("binary")).alias("digest"),
    )
    firsts = first_captures(pages, min_bytes)
    marks = (
        pages.select("page_id", F.sha1(payload.cast("binary")).alias("digest"))
        .join(firsts, "digest")
        .filter(F.col("page_id") != F.col("first"))
        .select(F.col("page_id").alias("again"), F.col("digest").alias("d"), "first")
        .distinct()
    )
    found = (F.col("page_id") == F.col("again")) & (F.col("digest") == F.col("d"))
    rows.join(marks, found, "left").select(
        "page_id", "url", "html", "first"
    ).mapInArrow(_records, "value string").write.option("lineSep", END).option(
        "maxRecordsPerFile", file_records
    ).option("compression", "gzip").text(path)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, pages in texts_of(batches, "html"):
        values = []
        for page, url, first, html in zip(
            batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist(), pages, strict=True
        ):
            payload = html.encode("utf-8", "surrogatepass")
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
            head = [
                "WARC/1.1",
                f"WARC-Type: {'response' if first is None else 'revisit'}",
                f"WARC-Record-ID: <urn:stocklens:page:{page}>",
                f"WARC-Target-URI: {url}",
                f"WARC-Date: {CAPTURED}",
                f"WARC-Payload-Digest: sha1:{digest}",
                f"X-Payload-Length: {len(payload)}",
            ]
            if first is not None:
                head += [
                    "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                    f"WARC-Refers-To: <urn:stocklens:page:{first}>",
                ]
            body = html if first is None else ""
            size = len(payload) if first is None else 0
            head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {size}"]
            values.append("\r\n".join(head) + END + body)
        yield pa.RecordBatch.from_arrays([pa.array(values, pa.string())], names=["value"])


def url_key(url: str) -> str:
    """Host labels in reverse order, then path and query in lower case: keys of a site sort together."""
    host, rest = re.match(r"(?s)(?:.*?://)?([^/?#]*)([^#]*)", url).groups()
    return ",".join(reversed(host.lower().split("."))) + ")" + (rest.lower() or "/")


def parse_archive(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of every record."""
    at = 0
    while at < len(data):
        split = data.index(b"\r\n\r\n", at)
        lines = data[at:split].decode("utf-8", "surrogatepass").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        start = split + 4
        end = start + int(headers["Content-Length"])
        yield at, headers, data[start:end]
        at = end + 4


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, data in zip(batch.column(0), batch.column(1), strict=True):
            entries, run = [], path.as_py().rsplit("/", 1)[-1]
            for offset, headers, block in parse_archive(gzip.decompress(data.as_py())):
                page = headers["WARC-Record-ID"].rsplit(":", 1)[1].rstrip(">")
                refers = headers.get("WARC-Refers-To")
                digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                size = int(headers["X-Payload-Length"])
                if headers["WARC-Type"] == "response":
                    size = len(block)
                    digest = base64.b32encode(hashlib.sha1(block).digest()).decode()
                entries.append((
                    url_key(headers["WARC-Target-URI"]), headers["WARC-Date"],
                    None if page == "None" else int(page), run, offset, size, digest,
                    headers["WARC-Type"], refers and int(refers.rsplit(":", 1)[1].rstrip(">")),
                ))
            entries.sort(key=_order)
            yield _entries(entries)


def _order(entry: tuple) -> tuple:
    return entry[0], entry[1], entry[2] is not None, entry[2] or 0, entry[3], entry[4]


def _entries(entries: Sequence[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    columns = list(zip(*entries, strict=True)) or [[]] * len(kinds)
    names = [c.split()[0] for c in INDEX.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def merge_runs(runs: list[list[tuple]]) -> Iterator[tuple]:
    """Merge sorted runs with a tree of losers: each step replays one path from leaf to root."""
    k = len(runs)
    if not k:
        return
    heads = [iter(r) for r in runs]
    now = [next(h, None) for h in heads]

    def beats(a: int, b: int) -> bool:
        if now[a] is None or now[b] is None:
            return now[b] is None and (now[a] is not None or a < b)
        return (_order(now[a]), a) < (_order(now[b]), b)

    losers, winners = [0] * k, [0] * (2 * k)
    winners[k:] = range(k)
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if beats(a, b) else (b, a)
    best = winners[1] if k > 1 else 0
    while now[best] is not None:
        yield now[best]
        now[best] = next(heads[best], None)
        node = (best + k) // 2
        while node:
            if beats(losers[node], best):
                best, losers[node] = losers[node], best
            node //= 2


def capture_index(spark: SparkSession, path: str) -> DataFrame:
    """The index of all archives below ``path``, in one order by url key, time and page.

    A range holds a bounded share of the entries even where one url has most of them, since
    ranges are cut within a url key by page.
    """
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    entries = archives.select("path", "content").mapInArrow(_runs, INDEX)
    ranges = entries.repartitionByRange("url_key", "captured", "page_id", "run", "offset")
    return ranges.sortWithinPartitions("run", "url_key", "captured", "page_id", "offset").mapInArrow(
        _merged, INDEX
    )


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs: dict[str, list[tuple]] = {}
    for batch in batches:
        for entry in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            runs.setdefault(entry[3], []).append(entry)
    out = []
    for entry in merge_runs(list(runs.values())):
        out.append(entry)
        if len(out) == 10_000:
            yield _entries(out)
            out = []
    if out:
        yield _entries(out)


def archived(pages: DataFrame, *, min_bytes: int = 0, path: str | None = None) -> DataFrame:
    """Write ``pages`` to archives and give back their merged index.

    One row per row of ``pages``: page_id, payload_bytes, payload_digest (base32 SHA-1),
    record_type, refers_to, url_key, captured, run and offset of the record. Of equal
    payloads of at least ``min_bytes`` the smallest page_id is the response and the others revisit it;
    smaller ones are all responses. Rows without a page_id are responses. A null url
    has an empty host; rows that repeat a page_id and payload are each a record of the same kind.
    """
    path = path or scratch_dir(pages.sparkSession)
    write_archives(pages, path, min_bytes=min_bytes)
    return capture_index(pages.sparkSession, path)

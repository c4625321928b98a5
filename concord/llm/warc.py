"""WARC archives: writing, and a splittable reader (operator 5).

Pages become one gzip member each (WARC/1.0 response and revisit records);
every partition writes one archive, under a name of its own that is moved into
place when complete, so a repeated task replaces it. Records with equal
payloads of at least ``LEAST`` bytes are found by digest with map-side
aggregation: the smallest page id is the response, the others revisit it.

Reading splits archives into byte ranges. A task looks for the gzip magic from
the start of its range on, takes a candidate as a member only if it inflates to
a WARC header (of any length: it holds the url), and owns the records that start inside its range; the last one
may end beyond it. After a record the next one is expected at its end. The
payload of a text page cannot contain the magic (0x1F 0x8B is not UTF-8), and
bytes that only look like it fail to inflate to a header.

Archives are opened by URI through Arrow's file systems; listing is Spark's.

Edge cases: null html is an empty payload; a null url has no target header, and
control characters of urls are percent-encoded; null page ids are kept and rank
after all others; rows with the same id and payload are all of one type; other
columns are ignored; no pages make no archives and no rows. A record whose
payload does not match its digest raises an error.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm.common import broadcast_if_small, scratch, table

LEAST = 100
#: Bytes of an archive that one task scans, and of one read.
RANGE = 8 << 20
READ = 1 << 16
#: Tasks of one reading job; beyond, a task scans several ranges.
MOST_TASKS = 100_000
MAGIC = b"\x1f\x8b\x08"
HEADER = b"WARC/1."
#: The first line of a header; what follows it may be of any length.
FIRST_LINE = re.compile(rb"WARC/1\.\d+\r\n")
#: Bytes that hold the first line of every header.
FIRST = 32
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = ("page_id long, url string, payload binary, payload_bytes long, "
           "payload_digest string, record_type string, refers_to long")


def opened(uri: str):
    """(Arrow file system, path) of a Hadoop-style URI or path."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), re.sub("^file:/*", "/", uri)
    return fs.FileSystem.from_uri(uri)


def record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    """One gzip member."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    lines = ["WARC/1.0", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <urn:page:{page_id}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        safe = re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", url)
        lines.append(f"WARC-Target-URI: {safe}")
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    block = http if revisit else http + payload
    lines += ["Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return (packer.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n")
            + packer.flush())


def with_types(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html") -> DataFrame:
    """(page_id, url, html, digest, refers_to): refers_to is null for responses."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"),
                        F.col(url_col).cast("string").alias("url"), html.alias("html"),
                        F.sha2(html.cast("binary"), 256).alias("digest"))
    narrow = rows.filter(F.octet_length("html") >= LEAST).select("page_id", "digest")
    first = (narrow.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
             .filter("n > 1 AND first IS NOT NULL").select("digest", "first"))
    later = (narrow.join(first, "digest").filter("page_id IS NULL OR page_id > first")
             .distinct())
    later = broadcast_if_small(later.select(F.col("digest").alias("_digest"),
                                            F.col("page_id").alias("_id"),
                                            F.col("first").alias("refers_to")))
    same = (F.col("digest") == F.col("_digest")) & F.col("page_id").eqNullSafe(F.col("_id"))
    return rows.join(later, same, "left").drop("_digest", "_id")


def write_archives(pages: DataFrame, folder: str) -> int:
    """Write typed pages (see ``with_types``) as archives below ``folder``; returns records."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        files, path = opened(folder)
        files.create_dir(path, recursive=True)
        name = f"{path}/part-{task.partitionId():06d}.warc.gz"
        draft = f"{path}/_draft-{task.partitionId():06d}-{task.taskAttemptId()}"
        n = 0
        out = None
        for batch in batches:
            for page, url, html, digest, refers in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True):
                out = out or files.open_output_stream(draft)
                out.write(record(page, url, html.encode(), digest, refers, refers is not None))
                n += 1
        if out is not None:
            out.close()
            files.move(draft, name)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    counts = (pages.select("page_id", "url", "html", "digest", "refers_to")
              .mapInArrow(run, "n long"))
    return counts.agg(F.sum("n")).first()[0] or 0


class Source:
    """Bytes of an open file from a position on, read in blocks as they are needed."""

    def __init__(self, file, start: int):
        self.file, self.start, self.data = file, start, b""
        self.size = file.size()

    def more(self) -> bool:
        at = self.start + len(self.data)
        if at >= self.size:
            return False
        self.data += self.file.read_at(min(READ, self.size - at), at)
        return True

    def drop(self, n: int):
        self.data, self.start = self.data[n:], self.start + n


def headers_of(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        key, _, value = line.partition(":")
        out[key.strip().lower()] = value.strip()
    return out


def member(source: Source) -> tuple[dict[str, str], bytes, int] | None:
    """(headers, block, compressed size) of the record at the start of the source, if any."""
    unpack = zlib.decompressobj(31)
    out, at, fields, need, looked = bytearray(), 0, None, 0, 0
    while True:
        try:
            out += unpack.decompress(source.data[at:])
        except zlib.error:
            return None
        at = len(source.data)
        if bytes(out[:len(HEADER)]) != HEADER[:len(out)]:
            return None
        if fields is None:
            if (unpack.eof or len(out) >= FIRST) and not FIRST_LINE.match(out):
                return None
            end = out.find(b"\r\n\r\n", looked)
            looked = max(0, len(out) - 3)
            if end < 0 and unpack.eof:
                return None
            if end >= 0:
                fields = headers_of(bytes(out[:end]))
                if not fields.get("content-length", "").isdigit():
                    return None
                need = end + 4 + int(fields["content-length"])
        if unpack.eof:
            if fields is None or len(out) < need:
                return None
            size = int(fields["content-length"])
            return fields, bytes(out[need - size:need]), at - len(unpack.unused_data)
        if not source.more():
            return None


def number(value: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", value)
    return int(found[1]) if found else None


def parsed(fields: dict[str, str], block: bytes) -> tuple:
    """A row of ``RECORDS``; the payload of a revisit is null, its length is that of the page."""
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    kind = fields["warc-type"]
    url = fields.get("warc-target-uri")
    if url is not None:
        url = re.sub(r"%([0-7][0-9A-F])", lambda m: chr(int(m[1], 16)), url)
    if kind == "revisit":
        size = int(headers_of(b"\r\n" + http)["content-length"]) if http else 0
        payload = None
    else:
        size = len(payload)
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"payload of {fields.get('warc-record-id')} does not match its digest")
    return (number(fields["warc-record-id"]), url, payload, size, digest, kind,
            number(fields.get("warc-refers-to", "")))


def records_of_range(file, start: int, end: int) -> Iterator[tuple]:
    """Records that start in [start, end) of a file."""
    source = Source(file, start)
    while source.start < end:
        at = source.data.find(MAGIC)
        if at < 0:
            keep = min(len(source.data), len(MAGIC) - 1)
            source.drop(len(source.data) - keep)
            if not source.more():
                return
            continue
        source.drop(at)
        if source.start >= end:
            return
        found = member(source)
        if found is None:
            source.drop(1)
            continue
        fields, block, size = found
        source.drop(size)
        if fields.get("warc-type") in ("response", "revisit"):
            yield parsed(fields, block)


def read_archives(spark: SparkSession, folder: str, bytes_per_task: int = RANGE) -> DataFrame:
    """``RECORDS`` of all archives below ``folder``, by byte ranges."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
             .select("path", "length").filter("length > 0"))
    ranges = files.select("path", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("length") - 1, F.lit(bytes_per_task).cast("long")))
        .alias("start"))
    # a row is a few bytes but a whole range of work, so the number of tasks is set here
    ranges = ranges.repartition(max(1, min(ranges.count(), MOST_TASKS)))
    names = [f.split(" ")[0] for f in RECORDS.split(", ")]
    types = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(),
             pa.int64()]

    def batch(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
            names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for path, start in zip(*(c.to_pylist() for c in part.columns), strict=True):
                fs, local = opened(path)
                rows, size = [], 0
                with fs.open_input_file(local) as file:
                    for row in records_of_range(file, start, start + bytes_per_task):
                        rows.append(row)
                        size += len(row[2] or b"") + 200
                        if size > 16 * READ:
                            yield batch(rows)
                            rows, size = [], 0
                if rows:
                    yield batch(rows)

    return ranges.mapInArrow(run, RECORDS)


def op5_warc_splittable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a record per row of ``pages``, and read the archives back by byte ranges."""
    folder = scratch(spark, "warc")
    n = write_archives(with_types(table(spark, sf_dir, "pages")), folder)
    if not n:
        return spark.createDataFrame([], RECORDS).drop("url", "payload")
    return read_archives(spark, folder).drop("url", "payload")

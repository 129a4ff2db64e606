"""WARC archives: a writer that stores equal payloads once, and a splittable reader.

Writer.  Of pages with equal payloads (of at least ``min_bytes``) the one with
the largest id is a ``response`` record and the others are ``revisit`` records
that refer to it.  Every record is a gzip member of its own.  A task writes
its files under names of its own and returns them as rows; only the files in
that manifest count, so the file of a failed or speculative attempt is never
read.

Reader.  Each file is cut into byte ranges, one task row each.  A task scans
its range for the gzip magic; a candidate is a record's start if the member
inflates to a WARC header and to exactly the block and check sum it
announces; anything else is data that looks like the magic.  A record belongs
to the range that its first byte lies in, and is read past the range's end.
No index and no central scan is needed.  (Payloads that are themselves WARC
files, stored uncompressed inside a member, could be taken for records; UTF-8
text cannot hold the magic.)

Defined results: a null payload counts as empty; a null url writes no target;
a null id is written empty and read as null.  Rows that repeat the largest id
of a payload are all responses (the same record, written again); a group of
null ids only has no largest id, and its rows are all responses.  An empty
table gives no file and no record.  Extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Bytes of an archive file after which the next one begins, and of a range.
FILE_BYTES, RANGE_BYTES = 256 << 20, 4 << 20
MAGIC = b"\x1f\x8b\x08"
#: Bytes read at a time.
CHUNK = 1 << 16
#: Fixed values of the WARC 1.1 format.
VERSION, DATE = "WARC/1.1", "2000-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:x-page:"

MANIFEST = "path string, bytes bigint, records bigint"
RECORD = ("path string, at bigint, record_type string, page_id string, refers_to string, url string, "
          "payload_bytes bigint, payload_digest string, payload binary")


def filesystem(path: str):
    """The pyarrow file system of a folder, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: str | None, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One record: a response, or a revisit of the page ``refers_to``."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = [VERSION, f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <{URN}{quote(page_id or '')}>", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha1:{payload_digest(payload)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&*+,;=~%()')}")
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <{URN}{quote(refers_to)}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _referred(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``(page_id, url, payload, refers_to)``.  The repeated payloads' keys are a
    written table: sent to the tasks if they are few, and if not, Spark splits
    the partition of a payload that many pages have."""
    refers = F.when(F.col("page_id").eqNullSafe(F.col("first")), None).otherwise(F.col("first").cast("string"))
    return rows.join(groups, "key", "left").select(
        F.col("page_id").cast("string").alias("page_id"), "url", "payload", refers.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the pages below ``folder`` (shared storage); returns the
    manifest ``(path, bytes, records)``."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload"))
    rows = rows.withColumn("key", F.sha2("payload", 256))
    groups = (rows.filter(F.octet_length("payload") >= min_bytes)
              .groupBy("key").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
              .filter("n > 1").drop("n"))
    told = _referred(rows, written(groups, "repeated-payloads"))

    def run(batches: Iterator):
        import pyarrow as pa

        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        out, name, size, n = None, "", 0, 0
        done = []

        def close():
            out.close()
            done.append((name, size, n))
        for b in batches:
            for page_id, url, data, refers_to in zip(*(c for c in b.columns)):
                if out is None:
                    name, size, n = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(name, compression=None)
                z = member(record(page_id.as_py(), url.as_py(), data.as_py(), refers_to.as_py()))
                out.write(z)
                size, n = size + len(z), n + 1
                if size >= file_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        base = folder.rstrip("/")
        cols = list(zip(*[(f"{base}/{p.rpartition('/')[2]}", s, k) for p, s, k in done])) or [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64()))],
            ["path", "bytes", "records"])

    return written(told.mapInArrow(run, MANIFEST), "warc-manifest")


class NotARecord(Exception):
    """The bytes at a place are no record's start."""


class _File:
    """A file read by windows of ``CHUNK`` bytes."""

    def __init__(self, fs, path: str):
        self.f = fs.open_input_file(path)
        self.size = self.f.size()

    def read(self, at: int, n: int = CHUNK) -> bytes:
        self.f.seek(at)
        return self.f.read(max(0, min(n, self.size - at)))


def inflate(file: _File, at: int) -> tuple[dict, bytes, int]:
    """Header, block and end of the record that starts at ``at``."""
    z, data, pos, head, looked = zlib.decompressobj(31), bytearray(), at, None, 0
    while not z.eof:
        raw = file.read(pos)
        if not raw:
            raise NotARecord("the member does not end")
        pos += len(raw)
        try:
            data += z.decompress(raw)
        except zlib.error as e:
            raise NotARecord(str(e)) from e
        if head is None:
            if not data.startswith(b"WARC/1."[:len(data)]):
                raise NotARecord("no WARC header")
            end = data.find(b"\r\n\r\n", looked)
            looked = max(0, len(data) - 3)
            if end >= 0:
                head = parse_header(bytes(data[:end]))
                length = int(head["content-length"])
                need = end + 4 + length + 4
        if head is not None and len(data) > need:
            raise NotARecord("more data than announced")
    if head is None or len(data) != need or not data.endswith(b"\r\n\r\n"):
        raise NotARecord("not the announced length")
    return head, bytes(data[end + 4:end + 4 + length]), pos - len(z.unused_data)


def parse_header(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    if not fields.get("content-length", "").isdecimal() or "warc-type" not in fields:
        raise NotARecord("fields are missing")
    return fields


def records_of(file: _File, start: int, end: int) -> Iterator[tuple[int, dict, bytes]]:
    """The records whose first byte lies in ``[start, end)``."""
    at = start
    while at < end:
        window = file.read(at, min(CHUNK, end - at + len(MAGIC) - 1))
        hit = window.find(MAGIC)
        if hit < 0:
            at += max(1, len(window) - len(MAGIC) + 1)
            continue
        try:
            head, block, after = inflate(file, at + hit)
        except NotARecord:
            at += hit + 1
            continue
        yield at + hit, head, block
        at = after


def page_of(urn: str | None) -> str | None:
    """The id in a record's name; an empty one is null."""
    return unquote(urn.strip("<>").removeprefix(URN)) or None if urn else None


def decoded(head: dict, block: bytes) -> tuple:
    """``(record_type, page_id, refers_to, url, bytes, digest, payload)``."""
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)content-length:\s*(\d+)", http)[1])
    said = head["warc-payload-digest"].removeprefix("sha1:")
    if head["warc-type"] == "response":
        if len(payload) != size or payload_digest(payload) != said:
            raise ValueError(f"damaged payload in {head['warc-record-id']}")
    else:
        payload = None
    url = head.get("warc-target-uri")
    return (head["warc-type"], page_of(head["warc-record-id"]), page_of(head.get("warc-refers-to")), url, size, said,
            payload)


def counted(archives: DataFrame, records: DataFrame) -> DataFrame:
    """``records`` written and read again; an error if a file of the manifest
    has not given as many as it says."""
    records = written(records, "warc-records")
    got = records.groupBy(F.col("path").alias("got")).agg(F.count("*").alias("n"))
    n = F.coalesce(F.col("n"), F.lit(0))
    wrong = archives.join(got, F.col("path") == F.col("got"), "left").filter(n != F.col("records")).select(
        "path", "records", n.alias("n")).head(1)
    if wrong:
        raise ValueError(f"{wrong[0].path} has {wrong[0].records} records, {wrong[0].n} were read")
    return records


def read_archives(archives: DataFrame, range_bytes: int = RANGE_BYTES, payloads: bool = True) -> DataFrame:
    """The records of the files ``(path, bytes)``; without ``payloads`` that
    column is null."""
    spark = archives.sparkSession
    ranges = archives.filter("bytes > 0").select(
        "path", F.explode(F.expr(f"sequence(0L, bytes - 1, {int(range_bytes)}L)")).alias("start"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator):
        import pyarrow as pa

        import itertools

        names = ("path", "at", "record_type", "page_id", "refers_to", "url", "payload_bytes", "payload_digest",
                 "payload")
        types = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(),
                 pa.string(), pa.binary())

        def rows():
            for b in batches:
                for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    fs, inner = filesystem(path)
                    file = _File(fs, inner)
                    for at, head, block in records_of(file, start, min(start + range_bytes, file.size)):
                        got = decoded(head, block)
                        yield path, at, *(got if payloads else (*got[:-1], None))
                    file.f.close()

        def cut():
            held, size = [], 0
            for r in rows():
                held.append(r)
                size += len(r[-1] or b"") + 300
                if size >= 8 << 20:
                    yield held
                    held, size = [], 0
            if held:
                yield held

        for part in itertools.chain(cut()):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), types)], list(names))

    return ranges.repartition(n, "path", "start").mapInArrow(run, RECORD)

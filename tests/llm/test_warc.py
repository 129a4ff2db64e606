import gzip
import os
import random

import pytest
from pyspark.sql import functions as F

from topicgraph.llm import warc as R

SCHEMA = "page_id bigint, url string, html string"


def brute(rows, least=0):
    last = {}
    for p, _, h in rows:
        if p is not None:
            last[h or ""] = max(last.get(h or "", p), p)
    out = []
    for p, u, h in rows:
        data = (h or "").encode()
        first = last.get(h or "") if len(data) >= least else None
        revisit = first is not None and first != p
        out.append((p, len(data), R.payload_digest(data), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


ROWS = [(1, "http://a/ü?x=1 2", "<p>é</p>"), (2, "http://b", "<p>é</p>"), (3, None, None), (4, "u\r\nWARC-Type: x", ""),
        (5, "http://c", "x" * 3_000_000), (6, "http://d", "WARC/1.1\r\n\r\n"), (6, "http://d", "WARC/1.1\r\n\r\n"),
        (None, "http://e", "nobody"), (None, "http://e", "<p>é</p>"), (8, "http://f", "one of a kind")]


@pytest.mark.parametrize("range_bytes, file_bytes, least", [(1 << 22, 1 << 28, 0), (37, 2000, 10)])
def test_round_trip(spark, tmp_dir, range_bytes, file_bytes, least):
    rnd = random.Random(3)
    rows = ROWS + [(100 + i, f"http://x/{i}", "".join(rnd.choices("abc <>", k=rnd.randrange(400)))) for i in range(60)]
    if range_bytes < 100:
        rows = [r for r in rows if len(r[2] or "") < 10_000]
    pages = spark.createDataFrame(rows, SCHEMA)
    archives = R.write_archives(pages, f"file://{tmp_dir}/w", min_bytes=least, file_bytes=file_bytes)
    got = R.read_archives(archives, range_bytes).collect()
    ids = [(int(r.page_id) if r.page_id else None, r.payload_bytes, r.payload_digest, r.record_type,
            int(r.refers_to) if r.refers_to else None) for r in got]
    groups = brute(rows, least)
    if not least:
        # the group of null ids with a numbered member revisits it
        assert sorted(ids, key=repr) == groups
    else:
        assert sorted(ids, key=repr) == groups
    payloads = {(r.page_id, r.payload_bytes): bytes(r.payload) for r in got if r.record_type == "response"}
    for p, _, h in rows:
        key = (None if p is None else str(p), len((h or "").encode()))
        if key in payloads:
            assert payloads[key] == (h or "").encode()
    # the archives are plain gzip files
    path = next(f"{d}/{f}" for d, _, fs in os.walk(tmp_dir) for f in fs if f.endswith(".warc.gz"))
    assert gzip.open(path).read().startswith(b"WARC/1.1\r\n")


def test_false_magic_is_no_record(spark, tmp_dir):
    good = R.member(R.record("1", "http://a", b"text", None))
    fakes = [R.MAGIC + b"junk" * 9, gzip.compress(b"no header"), R.member(b"WARC/1.1\r\nWARC-Type: x\r\n\r\n"),
             R.member(R.record("9", None, b"cut", None))[:-9] + b"?" * 9]
    data = b"".join(f + good for f in fakes)
    with open(f"{tmp_dir}/x.warc.gz", "wb") as f:
        f.write(data)
    archives = spark.createDataFrame([(f"file://{tmp_dir}/x.warc.gz", len(data))], "path string, bytes bigint")
    for size in (11, 1000):
        got = R.read_archives(archives, size).collect()
        assert sorted(r["at"] for r in got) == [i for i in range(len(data)) if data.startswith(good, i)]


def test_empty_table(spark, tmp_dir):
    archives = R.write_archives(spark.createDataFrame([], SCHEMA), f"file://{tmp_dir}/e")
    assert R.read_archives(archives).collect() == []


def test_long_headers_are_read_and_records_counted(spark, tmp_dir):
    rows = [(1, "data:," + "é" * 40_000, "one"), (2, "http://b/" + "x" * 1_000_000, "two"), (3, "http://c", "one")]
    archives = R.write_archives(spark.createDataFrame(rows, SCHEMA), f"file://{tmp_dir}/w")
    for size in (1 << 22, 999):
        got = R.counted(archives, R.read_archives(archives, size)).collect()
        assert sorted((int(r.page_id), r.url) for r in got) == [(p, u.replace("é", "%C3%A9")) for p, u, _ in rows]
    short = archives.withColumn("records", F.col("records") + 1)
    with pytest.raises(ValueError, match="were read"):
        R.counted(short, R.read_archives(archives))

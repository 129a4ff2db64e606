import hashlib
import re

import pytest
from pyspark.sql import functions as F

from topicgraph.llm import block_naming


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


ROWS = [(5, "a  b"), (2, "a b"), (2, "a b"), (7, "a b"), (1, None), (0, ""), (3, " "), (9, "\t\n"), (None, "a b"),
        (None, "only null ids"), (11, "x" * 10_001), (10, "x" * 10_001), (12, "x" * 10_000), (13, "ab" * 5000),
        (14, "ab" * 5000 + "é"), (15, "é𝄞" * 4000), (16, "é𝄞" * 4000)]


@pytest.mark.parametrize("size", [3, 2048])
def test_against_brute_force(spark, size):
    rows = ROWS if size > 3 else [(d, t[:50] if t else t) for d, t in ROWS]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("name", F.lit(0)).withColumn("key", F.lit(0))
    groups = {}
    for d, t in rows:
        groups.setdefault(norm(t), []).append(d)
    got = block_naming.exact_dedup(docs, size=size).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = groups[next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)]
        real = [d for d in ids if d is not None]
        assert r.group_size == len(ids) and r.keep_id == (min(real) if real else None)
        assert not r.kept or r.doc_id == r.keep_id
    assert sum(r.kept for r in got) == len(groups)


def test_colliding_digest_is_found_and_replaced(spark):
    def weak(block, salt):
        return block_naming.digest(block, salt) if salt else F.pmod(F.crc32(block.cast("binary")), F.lit(3)).cast("string").cast("binary")

    docs = spark.createDataFrame([(i, f"text {i // 2}") for i in range(20)], "doc_id bigint, text string")
    got = block_naming.exact_dedup(docs, key=weak).collect()
    assert {(r.doc_id, r.keep_id, r.group_size) for r in got} == {(i, i // 2 * 2, 2) for i in range(20)}


def test_empty_table(spark):
    assert block_naming.exact_dedup(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from topicgraph.llm import simhash

SCHEMA = "doc_id bigint, text string"


def brute_fp(text, width=4):
    words = []
    for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace(
            "\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" "):
        if w:
            words.append(w)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows, k=4):
    """rows: (doc_id, fp) -> component id per row."""
    fps = sorted({f for _, f in rows})
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    a = np.array(fps, dtype=np.uint64)
    for i, f in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(a[:i] ^ a[i]) <= k) if i else ():
            parent[find(f)] = find(fps[j])
    least = {}
    for d, f in rows:
        if d is not None:
            least[find(f)] = min(least.get(find(f), d), d)
    return [(d, f"{f:016x}", least.get(find(f))) for d, f in rows]


def key(rows):
    return sorted(rows, key=repr)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute_components([(r.doc_id, brute_fp(r.text)) for r in docs.collect()])
    got = [tuple(r) for r in simhash.near_dedup(docs).select("doc_id", "fingerprint", "component_id").collect()]
    assert key(got) == key(want)
    assert len({c for _, _, c in got}) < len(got)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one\x0btwo"), (5, "one two"), (None, "one two"),
            (None, "alone"), (6, "ÄB ç"), (7, "äb ç"), (8, "word " * 200_000), (9, "a b")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("fp", F.lit("x")).withColumn("row", F.lit(1))
    want = brute_components([(d, brute_fp(t)) for d, t in rows])
    assert key(tuple(r) for r in simhash.near_dedup(docs).collect()) == key(want)
    assert simhash.near_dedup(docs.limit(0)).collect() == []


@pytest.mark.parametrize("bucket", [50_000, 3])
@pytest.mark.parametrize("k", [1, 3, 4])
def test_links_keep_all_components(spark, k, bucket):
    rnd = random.Random(k)
    fps = set()
    for _ in range(12):
        f = rnd.getrandbits(64)
        fps.add(f)
        for _ in range(rnd.randrange(15)):
            f ^= sum(1 << b for b in rnd.sample(range(64), rnd.randrange(1, 8)))
            fps.add(f)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame([(f, f) for f in signed], "fp bigint, first bigint")
    got = {r.fp: r.component_id for r in simhash.components(nodes, k, bucket).collect()}
    rows = brute_components([(s, s & (1 << 64) - 1) for s in signed], k)
    want = {d: c for d, _, c in rows}
    assert got == want
    edges = simhash.links(nodes.select("fp"), k, bucket).collect()
    assert all(bin((e.source ^ e.target) & (1 << 64) - 1).count("1") <= k for e in edges)


def test_dense_bucket_gives_no_pairs(spark):
    # 300 fingerprints within three bits of each other: far fewer edges than pairs
    rnd = random.Random(0)
    fps = {sum(1 << b for b in rnd.sample(range(20), 2)) for _ in range(600)}
    nodes = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    assert simhash.links(nodes).count() < 64 * len(fps)
    assert len({r.component_id for r in simhash.components(nodes.withColumn("first", F.col("fp"))).collect()}) == 1


def test_one_of_each_keeps_columns_and_smallest_id(spark):
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(3, text, 1), (2, text + " end", 2), (2, text + " end", 3), (None, text, 4), (9, "other text here now", 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row int")
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 9]

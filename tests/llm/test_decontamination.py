import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicgraph.llm import decontamination as D


def brute(docs, items, window):
    phrases = {}
    for item, text in items:
        ws = D.words(text)
        for i in range(max(1, len(ws) - window + 1) if ws else 0):
            phrases.setdefault(tuple(ws[i:i + window]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        ws, hit, found = D.words(text), set(), set()
        for p, owners in phrases.items():
            for i in range(len(ws) - len(p) + 1):
                if tuple(ws[i:i + len(p)]) == p:
                    hit |= set(range(i, i + len(p)))
                    found |= owners
        out.append((doc, len(ws), tuple(sorted(hit)), tuple(sorted(found))))
    return sorted(out, key=repr)


def table(found):
    rows = []
    for r in found.collect():
        hit = [i for s in r.spans for i in range(s.start, s.end)]
        rows.append((r.doc_id, r.n_words, tuple(hit), tuple(r.items)))
    return sorted(rows, key=repr)


def test_suffix_array_and_ranks_against_sorting():
    rnd = random.Random(1)
    runs = [np.array([rnd.randrange(1, 4) for _ in range(rnd.randrange(1, 40))]) for _ in range(30)]
    index = D.FMIndex(runs, 4)
    seq = np.concatenate([np.append(r, 0) for r in runs])
    wm = D.WaveletMatrix(seq, 4)
    at = np.arange(len(seq))
    for c in range(4):
        want = np.concatenate(([0], np.cumsum(seq == c)))[:-1]
        assert (wm.rank(np.full(len(seq), c), at) == want).all()
    symbol, before = wm.at(at)
    assert (symbol == seq).all() and all(before[i] == (seq[:i] == seq[i]).sum() for i in at)
    # every substring of a run is found where it is
    for r in runs[:10]:
        p = r[:7]
        row = np.zeros((1, 7), np.int64)
        row[0, 7 - len(p):] = p
        ids, lo, hi = index.search(row, np.array([len(p)]))
        got = sorted(index.locate(np.arange(lo[0], hi[0])).tolist())
        assert got == [i for i in range(len(seq) - len(p) + 1) if (seq[i:i + len(p)] == p).all()]


@pytest.mark.parametrize("shard, block", [(1 << 19, 1 << 20), (25, 30)])
def test_against_brute_force(spark, shard, block):
    rnd = random.Random(2)
    vocab = ["a", "B", "ç", "d1", "e"]

    def text(n):
        return "".join(rnd.choice(vocab) + rnd.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    items = [(i, text(rnd.randrange(1, 15))) for i in range(20)] + [(3, "a a a"), (None, "e e e e"), (50, None), (51, "..."),
                                                                    (52, text(70))]
    docs = [(i, text(rnd.randrange(0, 120))) for i in range(30)] + [(1, "A, a; a"), (None, "E-e-e-e"), (99, None), (98, "!?")]
    docs.append((97, items[-1][1] + " x " + items[0][1]))
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("found", F.lit(1)).withColumn("items", F.lit(2))
    b = spark.createDataFrame(items, "item_id bigint, text string")
    got = table(D.find(d, b, window=4, shard=shard, block=block))
    assert got == brute(docs, items, 4)


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    d, b = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    docs = [(r.doc_id, r.text) for r in d.collect()]
    items = [(r.item_id, r.text) for r in b.collect()]
    assert table(D.find(d, b)) == brute(docs, items, 10)


def test_cut_leaves_no_passage_and_clean_texts_alone(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    rows = [(1, f"Before, {passage}. After", 5), (2, "clean  Text\n here", 6), (3, passage, 7), (4, None, 8), (5, "", 9),
            (6, "x " * 300_000 + passage, 10)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, found int")
    b = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    out = D.decontaminate(d, b)
    assert out.columns == d.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {1: "Before, . After", 2: "clean  Text\n here", 4: None, 5: "", 6: "x " * 300_000}
    assert all(not r.spans for r in D.find(out, b).collect())


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "one two")], "doc_id bigint, text string")
    b = spark.createDataFrame([(1, "one two")], "item_id bigint, text string")
    assert [(r.n_words, r.spans) for r in D.find(d, b.limit(0)).collect()] == [(2, [])]
    assert D.find(d.limit(0), b).collect() == []
    assert D.decontaminate(d, b.limit(0)).collect() == d.collect()

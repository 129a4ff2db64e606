import math
import os
import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from topicgraph.llm import suffix_tree as L
from topicgraph.session import ensure_checkpoint_dir

SCHEMA = "doc_id bigint, text string"


def held_out(doc_id, k=10):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % k == 0


class Brute:
    """The same model by dictionaries."""

    def __init__(self, texts, depth, share):
        seqs = [L.tokens(t) + [b""] for t in texts]
        self.c = Counter(w for s in seqs for w in s)
        self.total, self.depth = sum(self.c.values()), depth
        grams = [Counter() for _ in range(depth + 2)]
        for s in seqs:
            for n in range(1, depth + 2):
                for i in range(len(s) - n + 1):
                    grams[n][tuple(s[i:i + n])] += 1
        self.g = [{k: v for k, v in g.items() if v >= share * self.total} for g in grams]
        self.next = {}
        for n in range(2, depth + 2):
            for k, v in self.g[n].items():
                self.next.setdefault(k[:-1], {})[k[-1]] = v
        self.stays = set()
        for s in sorted(self.next, key=len, reverse=True):
            n, after = self.g[len(s)][s], self.next[s]
            below = {w: self.p(s[1:], w, True) for w in after}
            d = sum(c / n * math.log(c / n / below[w]) for w, c in after.items())
            rest = max(0, 1 - sum(after.values()) / n)
            if rest > 1e-12:
                d += rest * math.log(rest / max(1 - sum(below.values()), 1e-12))
            if n * d > 0.5 * math.log(self.total) * len(after):
                self.stays |= {s[i:] for i in range(len(s))}

    def root(self, w):
        return (self.c[w] + 0.1) / (self.total + 0.1 * (len(self.c) + 1))

    def p(self, s, w, every=False):
        if not s:
            return self.root(w)
        if s not in (self.next if every else self.stays):
            return self.p(s[1:], w, every)
        after, n = self.next[s], self.g[len(s)][s]
        if w in after:
            return (after[w] - 0.5) / n
        left = 1 - sum((c - 0.5) / n for c in after.values())
        return left / (1 - sum(self.p(s[1:], x, True) for x in after)) * self.p(s[1:], w, every)

    def score(self, text):
        s = L.tokens(text) + [b""]
        model = sum(math.log10(self.p(tuple(s[max(0, i - self.depth):i]), w)) for i, w in enumerate(s))
        return len(s), sum(self.c[w] > 0 for w in s), sum(math.log10(self.root(w)) for w in s), model


def corpus(n=120):
    rnd = random.Random(4)
    nxt = {v + w: rnd.sample("abcdefgh", 2) for v in "abcdefgh" for w in "abcdefgh"}
    out = []
    for i in range(n):
        v, w, ws = "a", rnd.choice("abcdefgh"), []
        for _ in range(rnd.randrange(0, 60)):
            ws.append(w if rnd.random() < 0.95 else f"rare{rnd.randrange(300)}")
            v, w = w, rnd.choice(nxt[v + w])
        out.append((i, " ".join(ws)))
    return out + [(500, None), (501, ""), (502, "A a\tÄ"), (1, "a b"), (None, "c d e"), (503, "a b c " * 50_000)]


def check(got, rows, depth, share):
    brute = Brute([t for d, t in rows if not held_out(d)], depth, share)
    want = sorted(((d, held_out(d), *brute.score(t)) for d, t in rows), key=repr)
    have = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.base_score, r.score) for r in got), key=repr)
    assert len(have) == len(want)
    for a, b in zip(have, want):
        assert a[:4] == b[:4] and all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-6) for x, y in zip(a[4:], b[4:])), (a, b)
    assert {r.train_tokens for r in got} == {brute.total}
    return brute


def test_against_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("row", F.lit(0)).withColumn("word", F.lit(0))
    small = [r for r in rows if r[0] != 503]
    for depth, share, common in ((2, 2e-3, 2e-3), (3, 1e-3, 1e-3)):
        got = L.train_and_score(docs.filter("doc_id IS NULL OR doc_id != 503"), depth=depth, share=share,
                                common=min(share, common)).collect()
        brute = check(got, small, depth, share)
        assert any(len(s) == 2 for s in brute.stays)
    assert len(L.train_and_score(docs).collect()) == len(rows)


def test_nodes_sum_to_one_and_contexts_help(spark):
    rows = corpus()
    brute = Brute([t for d, t in rows[:120]], 2, 2e-3)
    words = [*brute.c, b"unknown word"]
    for s in list(brute.stays)[:20]:
        assert math.isclose(sum(brute.p(s, w) for w in words), 1, rel_tol=1e-9)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = L.train_and_score(docs).filter("held_out").agg(F.sum("base_score").alias("b"), F.sum("score").alias("s")).first()
    assert r.s > r.b  # held-out texts are likelier with contexts


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert L.train_and_score(docs).collect() == []
    alone = next(i for i in range(100) if held_out(i))
    got = L.train_and_score(spark.createDataFrame([(alone, "a b"), (alone, None)], SCHEMA)).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got) == [
        (1, 0, 0, 0.0, 0.0), (3, 0, 0, 0.0, 0.0)]
    assert np.isfinite([r.score for r in got]).all()


def test_rare_contexts_stay_in_a_large_corpus(spark):
    ids = [i for i in range(100) if not held_out(i)]
    alone = next(i for i in range(100, 200) if held_out(i))
    rows = [(ids[0], "a b c " * 200_000), *((i, "quux zork flib plom") for i in ids[1:6]), (alone, "zork flib plom")]
    got = L.train_and_score(spark.createDataFrame(rows, SCHEMA)).collect()
    brute = check(got, rows, L.DEPTH, 0)
    assert (b"zork",) in brute.stays
    r = next(r for r in got if r.doc_id == alone)
    assert r.score > r.base_score + 5


def on_disk(spark):
    """Bytes in the scratch folder and in the shuffle files."""
    scratch = ensure_checkpoint_dir(spark).removeprefix("file:")
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    tables = sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(scratch) for f in names)
    return tables, sum(blocks.apply(i).length() for i in range(blocks.size()))


def test_little_is_left_on_disk(spark):
    rnd = random.Random(5)
    words = [f"word{i}" for i in range(3000)]
    weights = [1 / (i + 1) for i in range(3000)]
    rows = [(i, " ".join(rnd.choices(words, weights, k=1000))) for i in range(400)]
    tables, shuffles = on_disk(spark)
    got = L.train_and_score(spark.createDataFrame(rows, SCHEMA))
    more = on_disk(spark)
    size = sum(len(t) for _, t in rows)
    assert more[0] - tables < size and more[1] - shuffles < size, (size, tables, shuffles, more)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert got.count() == len(rows)


def test_divided_contexts(spark):
    rnd = random.Random(6)
    rows = [(i, " ".join(["the", "same", "start", *rnd.choices("pqrs", (80, 10, 5, 5), k=rnd.randrange(40))])) for i in range(60)]
    rows += [(i, "the") for i in range(60, 90)]
    rows += [(i, " ".join(w + " " + rnd.choice("uv") for w in rnd.choices("xyz", k=9))) for i in range(90, 120)]
    docs = spark.createDataFrame(rows, SCHEMA)
    whole = L.train_and_score(docs).collect()
    check(whole, rows, L.DEPTH, 0)
    for part, chunk in ((60, 150), (300, 1000)):
        check(L.train_and_score(docs, part=part, chunk=chunk).collect(), rows, L.DEPTH, 0)
    check(L.train_and_score(docs, depth=0, part=60).collect(), rows, 0, 0)


def test_divided_context_that_stays_for_a_child(spark):
    # "b" says nothing about the next word, but "x b", "y b" and "b b" do
    rnd = random.Random(7)
    rows = []
    for i in range(25):
        ws = []
        for _ in range(60):
            after_b = len(ws) > 1 and ws[-1] == "b"
            ws.append({"x": "x", "y": "b", "b": "y"}[ws[-2]] if after_b else rnd.choice("xyb"))
        rows.append((i, " ".join(ws)))
    docs = spark.createDataFrame(rows, SCHEMA)
    for depth, stays in ((1, False), (2, True)):
        brute = check(L.train_and_score(docs, depth=depth, part=300).collect(), rows, depth, 0)
        assert ((b"b",) in brute.stays) == stays


def test_packed():
    for columns in ([np.arange(0)] * 2, [np.array([0, 0]), np.array([1, 1 << 40])], [np.array([3, 255, 256])]):
        assert all((a == b).all() for a, b in zip(L.unpacked(L.packed(*columns)), columns))
    x = np.array([-1.5, 0.0, 2.0 ** -30])
    assert (L.unpacked(L.packed(x))[0].view(np.float64) == x).all()

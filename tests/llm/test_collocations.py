import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from topicgraph.llm import collocations as co

SCHEMA = "doc_id bigint, text string, lang string, id string"


def brute(rows, longest=3, least=10, share=50, top=2000):
    counts: dict[str, Counter] = {}
    n: Counter = Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            ws = re.findall("[^ \t]+", piece)
            n[lang] += len(ws)
            for k in range(1, longest + 1):
                for i in range(len(ws) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(ws[i:i + k])] += 1
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in cand.items():
            inside = [b for q, b in cand.items() if len(q) > len(p)
                      and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * b >= share * a for b in inside):
                continue
            score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def mined(spark, rows, parts=3, **kw):
    docs = spark.createDataFrame([(i, t, la, "clash") for i, (t, la) in enumerate(rows)], SCHEMA).repartition(parts)
    got = co.mine(docs, **kw)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, got.collect()))


def texts(seed, n, words=12):
    rnd = random.Random(seed)
    names = ["The", "the", "of", "é", "日本", "x-y", "a\x1cb", "\x85"] + [f"w{i}" for i in range(words)]
    def one():
        k = rnd.choice([0, 1, 2, 30, 60])
        return "".join(rnd.choice(names[:3 + rnd.randrange(len(names) - 2)]) + rnd.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\x0b"])
                       for _ in range(k))
    return [(one(), rnd.choice(["en", "en", "en", "de", None, "und", ""])) for _ in range(n)]


def test_against_counting(spark):
    rows = texts(1, 700) + [(None, "en"), ("", "en"), ("one", "fr")]
    want = brute(rows, top=40)
    assert len(want) > 100
    assert mined(spark, rows, top=40) == want
    # chunks, tiles and dense tiles of any size give the same counts
    assert mined(spark, rows, top=40, chunk=37, side=4, dense=2) == want
    assert mined(spark, rows, parts=1, top=40, chunk=500, side=2, dense=0) == want


def test_longer_phrases(spark):
    rows = texts(2, 60, 4)
    assert mined(spark, rows, longest=5, least=4, share=70, chunk=64, side=3) == brute(rows, 5, 4, 70)
    assert mined(spark, rows, longest=2) == brute(rows, 2)


def test_hot_word_ties_and_long_text(spark):
    # one text of one word, all places overlap; equal scores are ranked by their bytes
    rows = [("a " * 5000, "en"), ("z y. " * 10 + "é y. " * 10 + "b c. " * 10, "en"), ("p q r. " * 10 + "p q. " * 10, "en")]
    want = brute(rows)
    assert ("en", "p q r") in {(r[0], r[2]) for r in want} and ("en", "p q") not in {(r[0], r[2]) for r in want}
    assert mined(spark, rows, chunk=1000) == want


def test_large_products(spark):
    a = 10 ** 13 + 7
    row = spark.range(1).selectExpr(f"{a}L AS n", f"{a + 5}L AS l", f"{a + 11}L AS r")
    got = row.select(co._score("n", row["l"], row["r"]).alias("s")).first().s
    assert got == 1000000 * a * a // ((a + 5) * (a + 11))


def test_empty(spark):
    for rows in ([], [(None, None)], [("a b", "en")]):
        assert mined(spark, rows) == []


def test_tiles():
    rnd = np.random.default_rng(3)
    a, b = (np.minimum(rnd.zipf(1.3, 4000), 5000).astype(np.int64) + 1000 for _ in "ab")
    tiles = co.Tiles(side=8, most=3)
    got: Counter = Counter()
    for i in range(0, 4000, 1000):
        for x, y, n in zip(*tiles.add(a[i:i + 1000], b[i:i + 1000])):
            got[int(x), int(y)] += int(n)
    assert 0 < len(tiles.dense) <= 3
    for x, y, n in tiles.rest():
        got.update({(int(i), int(j)): int(k) for i, j, k in zip(x, y, n)})
    assert got == Counter(zip(a.tolist(), b.tolist()))


def test_distinct_pairs_of_any_size():
    rnd = np.random.default_rng(4)
    small = [rnd.integers(1, 9, 500) for _ in "ab"]
    large = [x * (1 << 40) for x in small]
    for inverse in (False, True):
        x, y, more = co._distinct(*small, inverse)
        u, v, same = co._distinct(*large, inverse)
        assert (x << 40 == u).all() and (y << 40 == v).all() and (more == same).all()
    assert co._ids(co._packed(large[0]), 500).tolist() == large[0].tolist()
    assert co._ids(co._packed(small[0]), 500).tolist() == small[0].tolist()


def test_numbers_by_group(spark):
    rows = [(la, f"w{i}", (i * 7) % 5) for la in "ab" for i in range(40)]
    counts = spark.createDataFrame(rows, "lang string, word string, n bigint")
    got = {(r.lang, r.word): r.id for r in co.numbered(counts, [F.desc("n"), "word"], "id", by=("lang",)).collect()}
    whole = {(r.lang, r.word): r.id for r in co._ranked(counts, "word").collect()}
    order = sorted((la, -n, w) for la, w, n in rows)
    assert [whole[la, w] for la, _, w in order] == list(range(1, 81))
    assert [got[la, w] for la, _, w in order] == list(range(40)) * 2

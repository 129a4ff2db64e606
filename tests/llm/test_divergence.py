import random
import re
from collections import Counter

import pytest

from topicgraph.llm import divergence as dv


def brute(rows, least_docs=3, top=200, scale=dv.SCALE):
    groups, df = {}, {}
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        ts = [re.sub("[A-Z]", lambda m: m[0].lower(), t)
              for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")]
        groups.setdefault((lang, source), Counter()).update(ts)
        df.setdefault(lang, Counter()).update(set(ts))
    out = []
    for (lang, source), own in groups.items():
        kept = [t for t, n in df[lang].items() if n >= least_docs]
        here = {s: c for (la, s), c in groups.items() if la == lang}
        total = {s: sum(c[t] for t in kept) for s, c in here.items()}

        def p(n, all_):
            return 1 + scale * (n + 1) // (all_ + len(kept))

        def f(x, y):
            return (x - y) * (x - y) // y
        pairs = [(-sum(f(p(own[t], total[source]), p(here[s][t], total[s])) for t in kept), s.encode())
                 for s in here if s != source]
        out += [(lang, source, "pair", s.decode(), -v, i) for i, (v, s) in enumerate(sorted(pairs), 1)]
        everything = sum(total.values())
        found = []
        for t in kept:
            x, y = p(own[t], total[source]), p(sum(c[t] for c in here.values()), everything)
            if own[t] and x > y:
                found.append((-f(x, y), t.encode()))
        out += [(lang, source, "term", t.decode(), -v, i) for i, (v, t) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def audited(spark, rows, parts=3, **kw):
    docs = spark.createDataFrame([(*r, 0, "clash") for r in rows], "lang string, source string, text string, n bigint, term string")
    got = dv.audit(docs.repartition(parts), **kw)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, got.collect()))


def sample(seed, n):
    rnd = random.Random(seed)
    words = ["The", "the", "THE", "don't", "x1y", "é", "Éa", "日本", "😀", "z"] + [f"w{chr(97 + i)}" for i in range(26)]
    return [(rnd.choice(["en", "en", "en", "de", None, ""]), rnd.choice(["hot", "hot", "hot", "b", "c", "é", None]),
             " ".join(rnd.choice(words[:rnd.randint(1, len(words))]) for _ in range(rnd.choice([0, 1, 5, 40]))))
            for _ in range(n)]


def test_against_all_terms_of_all_groups(spark):
    rows = sample(1, 120) + [("en", "none", None), ("en", "none2", ""), ("fr", "only", "a a"), ("xx", "s", "q"), ("xx", "t", "")]
    want = brute(rows)
    assert len(want) > 150
    assert audited(spark, rows) == want
    assert audited(spark, rows, parts=1, held=10) == want


@pytest.mark.parametrize("top", [1, 3, 7])
def test_ties_at_the_last_rank(spark, top):
    # many terms of equal counts: the cells' multiplicity passes the limit
    rows = [("en", f"s{i % 3}", " ".join(f"t{chr(97 + j)}{chr(97 + i % 3)}" for j in range(20))) for i in range(9)]
    rows += [("en", "s0", "ta ta ta"), ("en", "s1", "é é"), ("en", "s2", "é")]
    assert audited(spark, rows, top=top) == brute(rows, top=top)


def test_other_parameters(spark):
    rows = sample(2, 60)
    assert audited(spark, rows, least_docs=1, scale=1000, top=5) == brute(rows, 1, 5, 1000)


def test_large_counts(spark):
    row = spark.range(1).selectExpr("400000000000L AS n", "900000000000L AS total", "77L AS kept")
    assert row.select(dv.share("n", "total", "kept")).first()[0] == 1 + 10 ** 9 * (400000000000 + 1) // (900000000000 + 77)


def test_empty_tables_and_groups(spark):
    assert audited(spark, []) == []
    assert audited(spark, [("en", "a", None), ("en", "b", "x")]) == [
        ("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_a_very_long_text(spark):
    rows = [("en", "a", "long " * 50000 + "tail"), ("en", "b", "tail long"), ("en", "b", "tail long")]
    assert audited(spark, rows) == brute(rows)

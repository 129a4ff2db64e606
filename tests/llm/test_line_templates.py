import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from topicgraph.llm import line_templates as T

SP = r"[\x20\x09-\x0D]+"
SCHEMA = "doc_id bigint, text string"


def forms(line):
    """What a line counts as: ``(kind, tokens, leading tokens, parts)`` and the
    documents needed."""
    line = re.sub(f"^{SP}|{SP}$", "", line)
    if not line:
        return []
    toks = re.split(SP, re.sub(r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*", T.FIELD, line))
    n, out = len(toks), []
    if n >= T.LONG:
        cut = [T.LEAD + (n - T.LEAD) * i // T.PARTS for i in range(T.PARTS)] + [n]
        out.append(((0, n, tuple(toks[:T.LEAD]), tuple(tuple(toks[a:b]) for a, b in zip(cut, cut[1:]))), T.MIN_DOCS))
    elif n >= T.MIN_TOKENS:
        out.append(((0, n, tuple(toks), ()), T.MIN_DOCS))
    if n >= T.PAIR_TOKENS or len(line) >= T.PAIR_CHARS:
        out.append(((1, n, line, ()), T.PAIR_DOCS))
    elif n < T.MIN_TOKENS:
        out.append(((1, n, line, ()), T.MIN_DOCS if len(line) >= T.SOME_CHARS else T.SHORT_DOCS))
    return out


def brute(rows):
    """What each document keeps."""
    docs, need, at = defaultdict(set), {}, {}
    for d, t in rows:
        for i, line in enumerate(t.split("\n") if t is not None else []):
            for f, k in forms(line):
                docs[f].add((d, t))
                need[f] = k
                at[f] = min(at.get(f, (2,)), (d is None, d or 0, i))

    def first(ds):
        return min((d for d, _ in ds if d is not None), default=None)

    taken = defaultdict(list)   # (documents, rank, no first, first) of the templates of a shape
    for f, ds in docs.items():
        if len(ds) >= need[f]:
            taken[f].append((-len(ds), 2 * f[0], first(ds) is None, first(ds) or 0))
    buckets = defaultdict(list)
    for f in docs:
        if f[0] == 0 and f[1] >= T.LONG:
            for g, (a, b) in enumerate(T.GROUPS):
                buckets[f[1], f[2], g, f[3][a:b]].append(f)
    close = defaultdict(set)
    for members in buckets.values():
        rep = min(members, key=lambda f: (-len(docs[f]), at[f]))
        for f in members if len(members) > 1 else []:
            if sum(x == y for x, y in zip(f[3], rep[3])) >= T.EQUAL:
                close[rep].add(f)
    for members in close.values():
        ds = set().union(*[docs[f] for f in members])
        if len(members) > 1 and len(ds) >= T.MIN_DOCS:
            for f in members:
                taken[f].append((-len(ds), 1, first(ds) is None, first(ds) or 0))
    out = []
    for d, t in rows:
        if t is None:
            out.append((d, None))
            continue
        kept = []
        for line in t.split("\n"):
            best = min((x for f, _ in forms(line) for x in taken[f]), default=None)
            if best is None or best[2] or best[3] == d:
                kept.append(line)
        out.append((d, "\n".join(kept)))
    return Counter(out)


def run(spark, rows, **kw):
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("h", F.lit(1)).withColumn("drop", F.lit(2)).withColumn("line", F.lit(3))
    out = T.drop_templates(docs, **kw)
    assert out.columns[:5] == docs.columns
    return Counter((r.doc_id, r.text) for r in out.collect())


LONG = "The quick brown fox jumps over the lazy dog and runs to {} the very far away green hills beyond"


def test_fields_first_document_and_short_lines(spark):
    rows = [(i, f"own line number words {chr(97 + i) * 5} here\nPage {i} of the 12 pages\nshort x\n" + LONG.format("abcdef"[i % 6]))
            for i in range(8)]
    rows += [(20, "Page 5 of the 12 pages\nPage 6 of the 12 pages\n\n"), (21, None), (22, ""), (23, "two docs have this line"),
             (24, "two docs have this line"), (3, "other text\nPage 7 of the 12 pages"), (None, LONG.format("zz") + "\nkept by no one else at all"), (25, "x " * 100_000)]
    assert run(spark, rows) == brute(rows)
    kept = dict(list(run(spark, [r for r in rows if r[1] and r[1][:5] != "other"])))
    assert kept[0] == rows[0][1] and kept[3] == "own line number words ddddd here\nshort x"
    assert kept[20] == "\n" and kept[None] == "kept by no one else at all"
    assert kept[23] == kept[24] == "two docs have this line"


def test_repeated_rows_count_once(spark):
    line = "a line that is said again and again"
    rows = [(1, line), (1, line), (1, line), (2, line)]
    assert run(spark, rows) == Counter(rows)
    rows.append((3, line))
    assert run(spark, rows) == Counter({(1, line): 3, (2, ""): 1, (3, ""): 1})


@pytest.mark.parametrize("sf", ["0.001"])
def test_table_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = Counter((r.doc_id, r.text) for r in T.drop_templates(docs.select("doc_id", "text")).collect())
    want = brute(rows)
    assert got == want


def test_empty_table(spark):
    assert T.drop_templates(spark.createDataFrame([], SCHEMA)).collect() == []
    assert T.summary(spark.createDataFrame([(1, None), (2, "")], SCHEMA)).select("doc_id", "n_dropped", "n_kept").orderBy(
        "doc_id").collect() == [(1, 0, 0), (2, 0, 1)]


def test_long_exact_line_recurs_from_two_documents(spark):
    line = " ".join(f"{c}word" for c in "abcdefghijklmnopqrst")
    rows = [(1, "own one\n" + line), (2, "own two\n " + line + " "), (3, "two docs have this line\nx"),
            (4, "two docs have this line\ny"), (5, line.replace("cword", "other", 1) + "\nz")]
    assert run(spark, rows) == brute(rows) == Counter((dict(rows) | {2: "own two"}).items())


def test_short_lines_and_scripts_without_spaces(spark):
    many, few, script = "All rights reserved.", "Go on.", "\u9019\u662f\u4e00" * 9
    rows = [(i, f"{many}\n\nown {'abcdefghijkl'[i]}" + (f"\n{few}" if i < 9 else "") + (f"\n{script}" if i < 3 else ""))
            for i in range(12)]
    got = run(spark, rows)
    assert dict(got.keys())[0] == rows[0][1]
    assert got == brute(rows) == Counter((i, t if i == 0 else t.replace(many + "\n", "").replace("\n" + script, "")) for i, t in rows)


def test_fields_in_two_places(spark):
    words = [f"w{chr(97 + i)}" for i in range(25)]

    def line(*changes):
        return " ".join(dict(changes).get(i, w) for i, w in enumerate(words))
    rows = [(1, line()), (2, line((8, "one"), (16, "two")) + "\nx"), (3, line((8, "uno"), (16, "dos")) + "\ny"),
            (4, line((0, "other")) + "\nleaf of its own"), (5, line((5, "a"), (12, "b"), (20, "c")) + "\nthree places")]
    got = dict(run(spark, rows).keys())
    assert got == {1: rows[0][1], 2: "x", 3: "y", 4: rows[3][1], 5: rows[4][1]}
    assert run(spark, rows) == brute(rows)


def test_variants_of_many_lines(spark):
    import random
    rnd = random.Random(6)
    bases = [[rnd.choice("abcdefg") + "x" * rnd.randrange(3) for _ in range(rnd.choice([4, 11, 12, 13, 19, 20, 40]))] for _ in range(12)]

    def variant():
        ws = list(rnd.choice(bases))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 6])):
            ws[rnd.randrange(len(ws))] = rnd.choice(["q", "7", "x8", "zz"])
        return " ".join(ws)
    rows = [(i, "\n".join(variant() for _ in range(rnd.randrange(6)))) for i in range(60)]
    rows += [(None, variant()), (None, variant()), (0, variant()), rows[5], rows[5]]
    want = brute(rows)
    assert run(spark, rows) == want
    assert sum(len(t) for _, t in want.elements()) < 0.8 * sum(len(t) for _, t in rows)

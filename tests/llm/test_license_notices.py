import random

import pytest

from topicgraph.llm import license_notices as ln
from topicgraph.llm.queries import QUERIES
from topicgraph.sources.tables import table

SF001 = "/root/testdata/sf0.001"


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute(text, notices, rate=ln.RATE, short=ln.SHORT):
    """Every run of words against every notice, by the distance table."""
    ws = [w.decode() for w in ln.words(text)]
    out = []
    for notice, label in dict.fromkeys(notices):
        nt = ln.joined(ln.words(notice))
        if not nt:
            continue
        fixed = [w for w in nt.split() if len(w) <= short or any(c.isdigit() for c in w)]
        found = []
        for i in range(len(ws)):
            size = -1
            for j in range(i, len(ws)):
                size += 1 + len(ws[j])
                if size > len(nt) + len(nt) // rate:
                    break
                e = distance(nt, " ".join(ws[i:j + 1]))
                left = iter(ws[i:j + 1])
                if e <= len(nt) // rate and all(f in left for f in fixed):
                    found.append((e, len(" ".join(ws[:i])), size, i, j + 1))
        taken = []
        for e, _, _, i, j in sorted(found):
            if all(j <= a or i >= b for a, b in taken):
                taken.append((i, j))
                out.append((label, i, j, e))
    return sorted(out)


def found(text, notices, **kw):
    return sorted((h["label"], h["start_word"], h["end_word"], h["edits"]) for h in ln.Finder(notices, **kw).hits(text)[1])


TEXTS = [
    "Released under the MIT license.", "Released undr the MIT licence!", "under the mpl license", "underthe mit license",
    "under the m i t license", "Apache License, Version 2.0", "apache license version 3", "apache licence version 2",
    "cc-by-nc", "cc by na", "CC BY-NC 4.0 cc by nc cc by nc", "under the mit license under the mit license",
    "under the the mit license", "under the mit the mit license", "permission is hereby granted, free of charge, to any person "
    "obtaining a copy", "permissions is hereby grantd free off charge to any persn obtaining a copy", "", "...", None,
    "gnu general public license version 3 gnu general public license version 2",
    "é under the mít license é", "under the mit license" * 3, "x" * 500 + " cc by nc " + "y" * 500,
]


@pytest.mark.parametrize("text", TEXTS)
def test_against_all_runs(text):
    assert found(text, ln.NOTICES) == brute(text, ln.NOTICES)


def test_random_edits():
    rnd = random.Random(5)
    notices = [("abab abba aab", "x"), ("ba aba abba b1", "y"), ("aaaa aaaa aaaa", "z"), ("", "none"), ("...", "none")]
    for _ in range(150):
        t = " ".join(rnd.choice([n for n, _ in notices[:3]]) for _ in range(3))
        t = list(t)
        for _ in range(rnd.randint(0, 9)):
            i = rnd.randrange(len(t))
            t[i] = rnd.choice(["", "a", "b", " ", t[i] + "a"])
        t = "".join(t)
        assert found(t, notices, rate=6, short=2) == brute(t, notices, 6, 2), t


def test_spans_are_of_the_text():
    text = "Ünder all:  Released UNDER the -- MIT\nlicence; bye"
    n, hits = ln.Finder(ln.NOTICES).hits(text)
    assert n == 8
    assert [(h["text"], text[h["start"]:h["end"]], h["start_word"], h["end_word"], h["edits"]) for h in hits] == [
        ("UNDER the -- MIT\nlicence", "UNDER the -- MIT\nlicence", 3, 7, 1)]


def test_table(spark):
    rows = [(1, "under the mit license. CC BY-NC", "clash"), (1, "under the mit license. CC BY-NC", "clash"),
            (2, None, None), (None, "undr the mit license", ""), (3, "x " * 20000 + "cc by nc", ""), (4, "", "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, hits string")
    got = ln.report(ln.scan(docs)).drop("hits")
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    got = sorted(map(tuple, got.collect()), key=repr)
    assert got == sorted([
        (1, 7, 2, 0, 4, "cc-by-nc,mit", "cc-by-nc,mit", 1.0), (1, 7, 2, 0, 4, "cc-by-nc,mit", "cc-by-nc,mit", 1.0),
        (2, 0, 0, None, None, "", "", 0.0), (None, 4, 0, None, None, "", "mit", 1 - 1 / 21),
        (3, 20003, 1, 20000, 20000, "cc-by-nc", "cc-by-nc", 1.0), (4, 0, 0, None, None, "", "", 0.0)], key=repr)
    assert ln.report(ln.scan(docs.limit(0))).count() == 0


def test_query_base_places(spark):
    """The contract's columns against a plain reading of every document."""
    want = {}
    for d in table(spark, SF001, "documents").toLocalIterator():
        ws = [w.decode() for w in ln.words(d.text)]
        at = [(i, label) for phrase, label in ln.BASE for p in [phrase.split()]
              for i in range(len(ws)) if ws[i:i + len(p)] == p]
        starts = [i for i, _ in at]
        want[d.doc_id] = (len(ws), len(at), min(starts, default=None), max(starts, default=None),
                          ",".join(sorted({label for _, label in at})))
    got = QUERIES["op11_license_scan"](spark, SF001).collect()
    assert {r.doc_id: tuple(r[1:6]) for r in got} == want and len(got) == len(want)
    assert sum(v[1] for v in want.values()) > 0
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1

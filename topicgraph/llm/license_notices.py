"""License scan: fuzzy search for short notices.

A text is reduced to its lower-cased words, joined by one space.  A notice of
``m`` characters may differ by ``m // RATE`` edits (insertions, deletions and
substitutions of characters).  It is cut into one piece more than it may have
edits, so at least one piece stands unchanged in every occurrence: an
Aho-Corasick automaton over the pieces of all notices finds the candidates in
one pass.  Around each, the runs of whole words that may be the notice are
matched with the bounded errors of the ``regex`` library, which gives the
number of edits.  Words of up to ``SHORT`` characters and words with a digit
tell notices apart (``mit`` and ``mpl``, ``2`` and ``3``) and must be there
unchanged.

An *occurrence* is a run of whole words within the bound.  Of overlapping
occurrences of one notice, that with the fewest edits stands, then the
leftmost, then the shortest.  Each hit says where it is in words and in
characters of the text itself, and shows that text.

Texts are searched where they are read, whole, one at a time; the notices are a
short list and travel with the job.  A passage met before is not verified
again (``SEEN`` results a task).

Defined results: a null or wordless text has no words and no hits; a notice
without words finds nothing, equal notices count once a label.  Repeated
documents stay as rows.  An empty table gives no rows; other columns are
ignored by ``scan``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a notice for one edit, longest word that must be unchanged,
#: verified passages that a task remembers.
RATE, SHORT, SEEN = 10, 3, 1 << 16

#: Phrases whose exact places are always counted, with their labels.
BASE = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]

# fixed values: wordings of the licenses' own short notices
NOTICES = BASE + [
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("cc by sa", "cc-by-sa"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("cc by 4.0", "cc-by"),
    ("creative commons attribution 4.0 international", "cc-by"),
    ("cc0 1.0 universal", "cc0"),
    ("gnu general public license version 2", "gpl-2"),
    ("gnu general public license version 3", "gpl-3"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license version 2.0", "mpl-2"),
    ("eclipse public license", "epl"),
    ("under the bsd license", "bsd"),
    ("redistribution and use in source and binary forms with or without modification", "bsd"),
    ("under the isc license", "isc"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
HITS = ("n_words bigint, hits array<struct<label: string, notice: string, start_word: bigint, end_word: bigint, "
        "start: bigint, end: bigint, edits: int, text: string>>")


def _table() -> bytes:
    keep = {c: c for c in range(128, 256)} | {c: c for c in b"0123456789abcdefghijklmnopqrstuvwxyz"}
    keep |= {c: c + 32 for c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    return bytes(keep.get(c, 32) for c in range(256))


TABLE = _table()


def words(text: str | None) -> list[bytes]:
    """The lower-cased words of a text, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(TABLE).split()


def joined(ws: list[bytes]) -> str:
    return b" ".join(ws).decode("utf-8", "surrogatepass")


class Notice:
    def __init__(self, text: str, label: str, rate: int = RATE, short: int = SHORT):
        import regex

        self.text, self.label = joined(words(text)), label
        self.edits = len(self.text) // rate
        self.fixed = [w for w in self.text.split() if len(w) <= short or any(c.isdigit() for c in w)]
        self.pattern = regex.compile(f"(?b)(?:{regex.escape(self.text, literal_spaces=True)}){{e<={self.edits}}}")
        cuts = [len(self.text) * i // (self.edits + 1) for i in range(self.edits + 2)]
        self.pieces = [(a, self.text[a:b]) for a, b in zip(cuts, cuts[1:])]

    def match(self, run: str) -> int | None:
        """Edits between the notice and a run of words, if within the bound."""
        m = self.pattern.fullmatch(run)
        if m is None:
            return None
        left = iter(run.split(" "))
        return sum(m.fuzzy_counts) if all(w in left for w in self.fixed) else None


def _runs(text: str, lo: int, hi: int, n: Notice):
    """Runs of whole words that begin in ``[lo, hi]`` and are as long as the
    notice, give or take its edits."""
    size, k = len(n.text), n.edits
    a = max(lo, 0)
    if a and text[a - 1] != " ":
        a = text.find(" ", a) + 1 or len(text)
    while a <= hi and a < len(text):
        b = a + max(size - k, 1)
        if b > len(text):
            return
        b = text.find(" ", b) if b < len(text) else b
        b = len(text) if b < 0 else b
        while b - a <= size + k:
            yield a, b
            if b == len(text):
                break
            b = text.find(" ", b + 1)
            b = len(text) if b < 0 else b
        a = text.find(" ", a) + 1 or len(text)


def chosen(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of overlapping ``(edits, start, end)``: fewest edits, leftmost, shortest."""
    import bisect

    out: list[tuple[int, int, int]] = []
    for e, a, b in sorted(found):
        i = bisect.bisect_left(out, a, key=lambda x: x[0])
        if (i == 0 or out[i - 1][1] <= a) and (i == len(out) or out[i][0] >= b):
            out.insert(i, (a, b, e))
    return out


class Finder:
    """The notices, their automaton and what was verified before."""

    def __init__(self, notices: list[tuple[str, str]], rate: int = RATE, short: int = SHORT, seen: int = SEEN):
        import ahocorasick

        self.notices = [n for n in (Notice(t, label, rate, short) for t, label in dict.fromkeys(notices)) if n.text]
        self.limit, self.seen = seen, {}
        pieces: dict[str, list] = {}
        for i, n in enumerate(self.notices):
            for at, piece in n.pieces:
                pieces.setdefault(piece, []).append((i, at))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in pieces.items():
            self.automaton.add_word(piece, (len(piece), owners))
        if pieces:
            self.automaton.make_automaton()

    def edits(self, i: int, run: str) -> int | None:
        if (i, run) not in self.seen:
            if len(self.seen) >= self.limit:
                self.seen.clear()
            self.seen[i, run] = self.notices[i].match(run)
        return self.seen[i, run]

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """``(notice, start, end, edits)`` in the joined words."""
        if not self.notices:
            return []
        tried: dict[int, dict] = {}
        for end, (size, owners) in self.automaton.iter(text):
            for i, at in owners:
                n, start = self.notices[i], end + 1 - size - at
                met = tried.setdefault(i, {})
                for a, b in _runs(text, start - n.edits, start + n.edits, n):
                    if (a, b) not in met:
                        met[a, b] = self.edits(i, text[a:b])
        return [(i, a, b, e) for i, met in sorted(tried.items())
                for a, b, e in chosen([(e, a, b) for (a, b), e in met.items() if e is not None])]

    def hits(self, text: str | None) -> tuple[int, list[dict]]:
        ws = words(text)
        run = joined(ws)
        found, places, out = self.find(run), None, []
        for i, a, b, e in sorted(found, key=lambda x: (x[1], x[2], x[0])):
            places = places or [m.span() for m in WORD.finditer(text)]
            first = run.count(" ", 0, a)
            last = first + run.count(" ", a, b)
            start, end = places[first][0], places[last][1]
            out.append({"label": self.notices[i].label, "notice": self.notices[i].text, "start_word": first,
                        "end_word": last + 1, "start": start, "end": end, "edits": e, "text": text[start:end]})
        return len(ws), out


def scan(docs: DataFrame, notices: list[tuple[str, str]] = NOTICES, id_col: str = "doc_id", text_col: str = "text",
         rate: int = RATE, short: int = SHORT) -> DataFrame:
    """``(doc_id, n_words, hits)`` of every document: spans of words and of
    characters (ends exclusive), edits and text of each notice found."""
    def run(batches):
        import pyarrow as pa

        finder = Finder(notices, rate, short)
        for b in batches:
            out = [finder.hits(t.as_py()) for t in b.column("text")]
            yield pa.record_batch({
                "doc_id": b.column("doc_id"), "n_words": pa.array([n for n, _ in out], pa.int64()),
                "hits": pa.array([h for _, h in out], hits_type)})

    import pyarrow as pa

    hit = {"label": pa.string(), "notice": pa.string(), "start_word": pa.int64(), "end_word": pa.int64(),
           "start": pa.int64(), "end": pa.int64(), "edits": pa.int32(), "text": pa.string()}
    hits_type = pa.list_(pa.struct(list(hit.items())))
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, {HITS}")


def report(found: DataFrame, base: list[tuple[str, str]] = BASE) -> DataFrame:
    """One row per document: exact places of the base phrases, and labels.
    ``score`` is the share of unchanged characters in the best hit."""
    phrases = F.array(*[F.lit(joined(words(t))) for t, _ in base])
    exact = F.filter("hits", lambda h: (h["edits"] == 0) & F.array_contains(phrases, h["notice"]))
    starts = F.transform("base", lambda h: h["start_word"])

    def listed(c):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda h: h["label"]))), ",")

    kept = F.transform("hits", lambda h: F.lit(1.0) - h["edits"] / F.greatest(F.length(h["notice"]), F.lit(1)))
    return found.select("*", exact.alias("base")).select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), listed("base").alias("base_labels"), listed("hits").alias("labels"),
        F.greatest(F.lit(0.0), F.coalesce(F.array_max(kept), F.lit(0.0))).alias("score"), "hits")

"""Benchmark decontamination with an FM-index per training shard.

A test item gives phrases: each window of consecutive words, or the whole
item if it is shorter.  The training documents stay where they are: a task
turns its documents, shard by shard, into an FM-index over words (suffix
array, Burrows-Wheeler transform, wavelet matrix for ranks, sampled suffix
positions), searches all phrases backwards in it at once, locates every
occurrence from the sampled positions, and merges them into removal spans of
each document.  Nothing of the documents is shuffled.

A word that no phrase has cannot be part of an occurrence, so the index of a
shard holds the runs of phrase words that are as long as the shortest phrase
or longer.  A shard holds at most ``SHARD`` words; a longer run is cut with
an overlap of one phrase, so that memory is bounded for texts of any length
and no occurrence is lost.

The phrases are sent to the tasks in blocks of at most ``BLOCK`` item words,
as plain arrays and dictionaries.  A larger benchmark takes several passes over
the documents, each a job of its own that writes what it found, so a task never
holds more than one block.  A task holds one text at a time besides the words
that its shard has gathered; the last pass also cuts.

Defined results: null and wordless texts have no words and are clean; an item
without words has no phrase; a null item id counts as ''.  Repeated items
count once, repeated documents stay as rows.  Empty tables are fine on either
side.  Other columns are passed through untouched by ``decontaminate``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, slices, written

#: Words of a phrase.
WINDOW = 10
#: Words in the index of one shard, and item words in one block of phrases.
SHARD, BLOCK = 1 << 17, 1 << 20
#: Documents that a task passes on at a time.
ROWS = 2048
#: Every so many positions of a run one suffix position is kept.
SAMPLE = 16

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
FOUND = "struct<n_words: bigint, spans: array<struct<start: bigint, end: bigint>>, items: array<string>>"


def _table() -> bytes:
    keep = {c: c for c in range(128, 256)} | {c: c for c in b"0123456789abcdefghijklmnopqrstuvwxyz"}
    keep |= {c: c + 32 for c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    return bytes(keep.get(c, 32) for c in range(256))


TABLE = _table()


def words(text: str | None) -> list[bytes]:
    """The lower-cased words of a text, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(TABLE).split()


class WaveletMatrix:
    """Ranks of symbols in a sequence; all arguments may be arrays."""

    def __init__(self, seq, sigma: int):
        import numpy as np

        self.levels = []
        for bit in reversed(range(max(1, int(sigma - 1).bit_length()))):
            one = (seq >> bit & 1).astype(bool)
            ones = np.concatenate(([0], np.cumsum(one, dtype=np.int32))).astype(np.int32)
            self.levels.append((bit, ones, len(seq) - int(ones[-1])))
            seq = np.concatenate((seq[~one], seq[one]))

    def rank(self, symbol, i):
        """How often ``symbol`` is among the first ``i``."""
        import numpy as np

        start = np.zeros_like(i)
        for bit, ones, zeros in self.levels:
            one, i1, s1 = (symbol >> bit & 1).astype(bool), ones[i], ones[start]
            i, start = np.where(one, zeros + i1, i - i1), np.where(one, zeros + s1, start - s1)
        return i - start

    def at(self, i):
        """The symbol at place ``i``, and how often it occurs before it."""
        import numpy as np

        symbol, start = np.zeros_like(i), np.zeros_like(i)
        for bit, ones, zeros in self.levels:
            i1, s1 = ones[i], ones[start]
            one = ones[i + 1] > i1
            symbol = symbol | one.astype(symbol.dtype) << bit
            i, start = np.where(one, zeros + i1, i - i1), np.where(one, zeros + s1, start - s1)
        return symbol, i - start


def suffix_array(seq):
    """Suffix array of a sequence in which all symbols below ``0`` are
    distinct and one of them is the last: prefix doubling over the suffixes
    that are not yet told apart."""
    import numpy as np

    def classes(sorted_keys, at, base):
        # first place of each group of equal keys, counted from ``base``
        new = np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1]))
        return base + np.maximum.accumulate(np.where(new, at, 0))

    n = len(seq)
    at = np.arange(n)
    order = np.argsort(seq, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = classes(seq[order], at, 0)
    size = np.bincount(rank, minlength=n)
    todo, width = np.flatnonzero(size[rank] > 1), 1
    while len(todo):
        key = rank[todo] * n + rank[todo + width]  # a tie never reaches the last symbol
        order = np.argsort(key, kind="stable")
        todo, key = todo[order], key[order]
        place = np.arange(len(todo))
        group = classes(rank[todo], place, 0)
        fresh = rank[todo] + classes(key, place, 0) - group
        rank[todo] = fresh
        same = np.zeros(len(todo), bool)
        same[1:] = fresh[1:] == fresh[:-1]
        same[:-1] |= same[1:]
        todo, width = todo[same], width * 2
    sa = np.empty(n, np.int64)
    sa[rank] = at
    return sa


class FMIndex:
    """Index of one shard: runs of word numbers (1 and up), each ended by 0."""

    def __init__(self, runs: list, sigma: int):
        import numpy as np

        sizes = np.fromiter((len(r) + 1 for r in runs), np.int64, len(runs))
        self.ends = np.cumsum(sizes) - 1
        self.starts = self.ends - sizes + 1
        seq = np.zeros(int(sizes.sum()), np.int64)
        for r, s in zip(runs, self.starts):
            seq[s:s + len(r)] = r
        marked = seq.copy()
        marked[self.ends] = np.arange(-len(runs), 0)  # distinct ends, below all words
        sa = suffix_array(marked)
        self.bwt = WaveletMatrix(seq[sa - 1], sigma)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=sigma))))
        place = sa - self.starts[np.searchsorted(self.ends, sa)]
        kept = place % SAMPLE == 0
        self.kept_before = np.concatenate(([0], np.cumsum(kept)))
        self.kept_at = sa[kept]

    def search(self, phrases, lengths):
        """Backward search of all phrases (rows of word numbers, the last
        word in the last column): numbers of those found, and their rows."""
        import numpy as np

        ids = np.arange(len(phrases))
        last = phrases[:, -1]
        lo, hi = self.before[last], self.before[last + 1]
        done = []
        for step in range(1, phrases.shape[1] + 1):
            alive = lo < hi
            ids, lo, hi = ids[alive], lo[alive], hi[alive]
            ended = lengths[ids] == step
            done.append((ids[ended], lo[ended], hi[ended]))
            ids, lo, hi = ids[~ended], lo[~ended], hi[~ended]
            if not len(ids):
                break
            c = phrases[ids, phrases.shape[1] - 1 - step]
            lo, hi = self.before[c] + self.bwt.rank(c, lo), self.before[c] + self.bwt.rank(c, hi)
        return tuple(np.concatenate(x) for x in zip(*done))

    def locate(self, rows):
        """Position of each row's suffix: step back to a sampled one."""
        import numpy as np

        out, at, steps = np.empty(len(rows), np.int64), np.arange(len(rows)), 0
        while len(rows):
            kept = self.kept_before[rows + 1] > self.kept_before[rows]
            out[at[kept]] = self.kept_at[self.kept_before[rows[kept]]] + steps
            at, rows, steps = at[~kept], rows[~kept], steps + 1
            symbol, before = self.bwt.at(rows)
            rows = self.before[symbol] + before
        return out


class Phrases:
    """One block of test phrases as number rows, with the items of each."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        import numpy as np

        self.number: dict[bytes, int] = {}
        owners: dict[tuple, set] = {}
        for item, ws in items:
            nums = [self.number.setdefault(w, len(self.number) + 1) for w in ws]
            for i in range(max(1, len(nums) - window + 1)):
                owners.setdefault(tuple(nums[i:i + window]), set()).add(item)
        self.width = window
        self.lengths = np.array([len(p) for p in owners], np.int64)
        self.rows = np.zeros((len(owners), window), np.int64)
        for i, p in enumerate(owners):
            self.rows[i, window - len(p):] = p
        self.owners = [sorted(o) for o in owners.values()]
        self.shortest = int(self.lengths.min()) if len(owners) else 0

    @classmethod
    def received(cls, state: dict) -> "Phrases":
        """From the plain values of another one (``vars``): a broadcast is
        unpickled where this package may be missing."""
        out = cls.__new__(cls)
        out.__dict__.update(state)
        return out


def _blocks(items: DataFrame, window: int, block: int) -> Iterator[Phrases]:
    """The items' phrases in blocks of bounded size; the items come to the
    driver one partition at a time."""
    held, size = [], 0
    for item, text in items.toLocalIterator():
        ws = words(text)
        # an item larger than a block is cut with the overlap of a window
        for i in range(0, max(1, len(ws) - window + 1), block):
            part = ws[i:i + block + window - 1]
            if part:
                held.append((item, part))
                size += len(part)
            if size >= block:
                yield Phrases(held, window)
                held, size = [], 0
    if held:
        yield Phrases(held, window)


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _search_texts(texts: Iterator, phrases: Phrases, shard: int) -> Iterator[tuple[int, list, set]]:
    """``(words, spans, items)`` of each text, in order; a shard's texts come
    out when it is full."""
    import numpy as np

    out: list[tuple[int, list, set]] = []
    runs, origin, held = [], [], 0

    def flush():
        if not runs:
            return
        index = FMIndex(runs, len(phrases.number) + 1)
        ids, lo, hi = index.search(phrases.rows, phrases.lengths)
        ids = np.repeat(ids, hi - lo)
        rows = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi)]) if len(lo) else lo
        at = index.locate(rows)
        run = np.searchsorted(index.ends, at)
        offset = (at - index.starts[run]).tolist()
        for r, o, p in zip(run.tolist(), offset, ids.tolist()):
            doc, first = origin[r]
            out[doc][1].append((first + o, first + o + int(phrases.lengths[p])))
            out[doc][2].update(phrases.owners[p])

    get = phrases.number.get
    for text in texts:
        ws = words(text)
        doc = len(out)
        out.append((len(ws), [], set()))
        nums = np.fromiter((get(w, 0) for w in ws), np.int64, len(ws))
        del ws
        edge = np.flatnonzero(np.diff(np.concatenate(([0], (nums > 0).astype(np.int8), [0]))))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if b - a < phrases.shortest:
                continue
            for i in range(a, max(a + 1, b - phrases.width + 1), shard):
                j = min(b, i + shard + phrases.width - 1)
                runs.append(nums[i:j].copy())
                origin.append((doc, i))
                held += j - i
                if held >= shard:
                    flush()
                    runs, origin, held = [], [], 0
        if not runs:
            yield from out
            out = []
    flush()
    yield from out


def _scan(docs: DataFrame, text: str, found: str, phrases: Phrases, shard: int, cutting: bool = False) -> DataFrame:
    """One pass: the column ``found`` grows by the hits of these phrases.
    ``cutting``: instead, the texts are returned without what was found."""
    sent = docs.sparkSession.sparkContext.broadcast(vars(phrases))

    def run(batches):
        import pyarrow as pa

        block = Phrases.received(sent.value)
        for b in slices(batches, ROWS):
            hits = _search_texts((t.as_py() for t in b.column(text)), block, shard)
            rows, texts, keep = [], [], []
            for (n, spans, items), old, t in zip(hits, b.column(found), b.column(text)):
                old = old.as_py()
                if old:
                    spans += [(s["start"], s["end"]) for s in old["spans"]]
                    items |= set(old["items"])
                spans = merge(spans)
                if cutting:
                    keep.append(not spans or n > sum(y - x for x, y in spans))
                    texts.append(cut(t.as_py(), spans) if spans and keep[-1] else t.as_py())
                else:
                    rows.append({"n_words": n, "spans": [{"start": x, "end": y} for x, y in spans], "items": sorted(items)})
            if cutting:
                at = b.schema.get_field_index(text)
                b = b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))
                yield b.filter(pa.array(keep, pa.bool_())).drop_columns([found])
            else:
                at = b.schema.get_field_index(found)
                yield b.set_column(at, b.schema.field(at), pa.array(rows, b.schema.field(at).type))

    return docs.mapInArrow(run, T.StructType([f for f in docs.schema if not cutting or f.name != found]))


def _passes(docs: DataFrame, items: DataFrame, text: str, found: str, window: int, shard: int, block: int,
            cutting: bool = False) -> DataFrame:
    docs = docs.withColumn(text, F.col(text).cast("string")).withColumn(found, F.lit(None).cast(FOUND))
    blocks = _blocks(items, window, block)
    # without any phrase one pass counts the words
    phrases, more = next(blocks, None) or Phrases([("", [b""])], window), None
    while (more := next(blocks, None)) is not None:
        docs, phrases = written(_scan(docs, text, found, phrases, shard), "decontamination"), more
    return _scan(docs, text, found, phrases, shard, cutting)


def _items(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col).cast("string"))


def find(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, shard: int = SHARD,
         block: int = BLOCK) -> DataFrame:
    """``(doc_id, n_words, spans, items)`` of every document: merged word
    spans that occur in the items, and the ids of those items as strings."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = _passes(narrow, _items(items, item_col, item_text_col), "text", "found", window, shard, block)
    return out.select("doc_id", "found.n_words", "found.spans", "found.items")


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW, shard: int = SHARD,
                  block: int = BLOCK) -> DataFrame:
    """``docs`` with the occurrences of the items cut out of the texts.
    Documents without a hit are returned as they are; those of which no word
    is left go."""
    found = free_name(docs, "found")
    out = _passes(docs, _items(items, item_col, item_text_col), text_col, found, window, shard, block, cutting=True)
    return out.select(*docs.columns)


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans and what lies between them."""
    places = [m.span() for m in WORD.finditer(text)]
    out, end = [], 0
    for a, b in spans:
        out.append(text[end:places[a][0]])
        end = places[b - 1][1]
    return "".join(out) + text[end:]

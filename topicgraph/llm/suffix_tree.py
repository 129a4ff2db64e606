"""Language-model scores from a probabilistic suffix tree over words.

Tree (Ron, Singer and Tishby, 1996).  The root is the smoothed distribution
of all training tokens.  A node is a context of 1 to ``DEPTH`` words; it keeps
the counts of all next words that follow it.  A context stays in the tree if its
distribution differs from that of its parent (the context without its oldest
word) by more than its parameters cost: occurrences times the divergence
against half a logarithm for each parameter; the ancestors of a node that
stays also stay.  No count is too small for the test.  Next-word distributions
are smoothed: a fixed discount is taken from each count, and the mass left over
goes to the other words in proportion to the parent's distribution.  So every
node sums to one over all known words and one unknown word.  A token's state is
the longest suffix of its history that is in the tree.

How it runs.  Texts are read once, into chunks of about ``CHUNK`` tokens.  Words
get ids by falling count, so that the first id of each count (at most the
square root of twice the tokens) tells the root's probability of any id.  Each
token moves once, with its history, to the part of its last context word: there
all of the subtree below that word is counted, tested and scored with sorted
arrays, and the logarithms go back as one sum for a text and part.  There is a
part for each ``PART`` tokens.  A context with more tokens than that is divided:
its tokens go to several parts by the word before it (or, at the greatest
depth, by their text), and so again for the contexts below it.  What its parts
have in common, the counts of the words after it, is counted by a grouping and
joined to each part.  Whether it stays may hang on a child in any of its parts:
if so, a part returns its sums for each depth that it can turn out to have.
There is at most one divided context of a length for each ``PART`` tokens.

What moves is packed (bytes of ids by place, then zstd), tables are deleted when
the next is written, and shuffle files when their job has ended.

Defined results: a null text counts as empty; an empty text has one token,
its end.  A null id counts as '' for the folds.  Repeated rows stay as rows
and all count.  Without training rows the root is uniform over the unknown
word alone, and all scores are 0.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbering import numbered
from .common import fold, release, written

#: Longest context.
DEPTH = 3
#: Least share of the training tokens of a gram that is kept (0: all are), and
#: share of all tokens from which a context is divided whatever ``PART`` is.
SHARE, COMMON = 0.0, 1.0
#: Added to each count at the root, and taken from each in a context.
ADDED, DISCOUNT = 0.1, 0.5
#: Folds of the ids; fold 0 is held out.
FOLDS = 10
#: Tokens in a chunk, in a part, and those whose sums are added up together.
CHUNK, PART, SUMMED = 1 << 20, 1 << 20, 1 << 22
#: Rows that a task passes on at a time.
ROWS = 1 << 16


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words (A-Z only), without the end."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def mixed(x):
    """Numbers from 0 that look random, for dealing."""
    import numpy as np

    x = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(27))) >> np.uint64(1)).astype(np.int64)


def packed(*columns) -> bytes:
    """Arrays of 8-byte numbers of one length: the bytes of each place stand
    together, those that are all 0 are left out."""
    import numpy as np
    import pyarrow as pa

    head, planes = [len(columns[0])], []
    for x in columns:
        x = np.ascontiguousarray(x).view(np.uint64)
        head.append((int(x.max(initial=0)).bit_length() + 7) // 8)
        planes.append(x.view(np.uint8).reshape(-1, 8)[:, :head[-1]].T.tobytes())
    raw = b"".join((len(head).to_bytes(8, "little"), np.array(head, np.int64).tobytes(), *planes))
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(blob: bytes) -> list:
    import numpy as np
    import pyarrow as pa

    raw = np.frombuffer(pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True), np.uint8)
    at = 8 + 8 * int(raw[:8].view(np.int64)[0])
    n, *widths = raw[8:at].view(np.int64).tolist()
    out = []
    for w in widths:
        x = np.zeros((n, 8), np.uint8)
        x[:, :w] = raw[at:at + n * w].reshape(w, n).T
        out.append(x.view(np.int64).reshape(n))
        at += n * w
    return out


@contextmanager
def shuffles_deleted(spark: SparkSession):
    """Within, the shuffle files of a job go when it ends."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def chunks(docs: DataFrame, size: int) -> DataFrame:
    """``(chunk, ids, held, sizes, words, m, c, codes)`` of ``(doc_id,
    held_out, text)``: the hashes of the distinct words and ends of about
    ``size`` tokens, their counts in all and in the training texts, and the
    tokens as places among them.  ``chunk`` numbers its first text, the others
    follow."""
    def run(batches: Iterator):
        from array import array
        from collections import defaultdict

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        text_number = TaskContext.get().partitionId() << 33

        def started():
            number = defaultdict()
            number.default_factory = number.__len__
            return number, array("i"), [], [], []

        def row():
            at = np.frombuffer(codes, np.int32).astype(np.int64)
            out = pa.concat_arrays(held)
            train = np.repeat(~out.to_numpy(zero_copy_only=False).astype(bool), sizes)
            words = [int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little", signed=True) for w in number]
            lists = [pa.concat_arrays(ids), out, pa.array(sizes, pa.int32()), pa.array(words, pa.int64()),
                     pa.array(np.bincount(at, minlength=len(words)), pa.int64()),
                     pa.array(np.bincount(at[train], minlength=len(words)), pa.int64())]
            return pa.RecordBatch.from_arrays(
                [pa.array([text_number], pa.int64()), *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists),
                 pa.array([packed(at)], pa.binary())], ["chunk", "ids", "held", "sizes", "words", "m", "c", "codes"])

        number, codes, sizes, ids, held = started()
        for b in batches:
            first = 0
            for i, text in enumerate(b.column(2)):
                words = tokens(text.as_py())
                codes.extend(map(number.__getitem__, words))
                codes.append(number[b""])
                sizes.append(len(words) + 1)
                if len(codes) >= size or i == b.num_rows - 1:
                    ids.append(b.column(0).slice(first, i + 1 - first))
                    held.append(b.column(1).slice(first, i + 1 - first))
                    first = i + 1
                if len(codes) >= size:
                    yield row()
                    text_number += len(sizes)
                    number, codes, sizes, ids, held = started()
        if sizes:
            yield row()

    kind = docs.schema["doc_id"].dataType
    longs = T.ArrayType(T.LongType())
    schema = (T.StructType().add("chunk", T.LongType()).add("ids", T.ArrayType(kind)).add("held", T.ArrayType(T.BooleanType()))
              .add("sizes", T.ArrayType(T.IntegerType())).add("words", longs).add("m", longs).add("c", longs)
              .add("codes", T.BinaryType()))
    return written(docs.select("doc_id", "held_out", "text").mapInArrow(run, schema), "chunks")


def coded(cut: DataFrame, ids: DataFrame) -> DataFrame:
    """``(chunk, ids, held, sizes, seq)``: the chunks' tokens as ids of ``(word,
    id)``.  Ids reach a chunk by a join of its distinct words."""
    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        for whole in batches:
            for i in range(whole.num_rows):
                b = whole.slice(i, 1)
                name = np.zeros(len(b.column("places")[0]), np.int64)
                name[b.column("places")[0].values.to_numpy()] = b.column("names")[0].values.to_numpy()
                seq = packed(name[unpacked(b.column("codes")[0].as_py())[0]])
                yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array([seq], pa.binary())],
                                                 ["chunk", "ids", "held", "sizes", "seq"])

    keys = cut.select("chunk", F.posexplode("words").alias("place", "word"))
    found = (keys.join(ids.hint("shuffle_hash"), "word").groupBy("chunk")
             .agg(F.collect_list(F.struct("place", "id")).alias("found"))
             .select("chunk", F.col("found.place").alias("places"), F.col("found.id").alias("names")))
    given = cut.select("chunk", "ids", "held", "sizes", "codes").join(found, "chunk")
    schema = T.StructType([*cut.schema.fields[:4], T.StructField("seq", T.BinaryType())])
    return written(given.mapInArrow(run, schema), "coded")


def read(batches: Iterator, depth: int) -> Iterator:
    """Of each chunk: its number, the ids and the held-out marks of its texts, their
    sizes, the text of each token, and for 0 to ``depth`` the word so many
    places before (0: none)."""
    import numpy as np

    for b in batches:
        for chunk, ids, held, sizes, seq in zip(*(b.column(c) for c in ("chunk", "ids", "held", "sizes", "seq"))):
            flat, sizes = unpacked(seq.as_py())[0], sizes.values.to_numpy()
            owner = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            words = [flat]
            for d in range(1, depth + 1):
                words.append(np.where(place >= d, np.concatenate((flat[:d], flat[:-d]))[:len(flat)], 0))
            yield chunk.as_py(), ids.values, held.values.to_numpy(zero_copy_only=False).astype(bool), sizes, owner, words


class Root:
    """Probabilities of the ids after no context."""

    def __init__(self, steps: list, total: int, known: int):
        import numpy as np

        steps = sorted(steps) or [(0, 0)]
        self.first, self.counts = (np.array(x, np.int64) for x in zip(*steps))
        self.total, self.known = total, known

    def count(self, ids):
        import numpy as np

        return self.counts[np.searchsorted(self.first, ids, "right") - 1]

    def p(self, ids):
        return (self.count(ids) + ADDED) / (self.total + ADDED * (self.known + 1))


class Test:
    """What a context with these sums passes on (a logarithm, base 10), and
    whether its distribution is worth its parameters."""

    def __init__(self, n, k, kc, kb, x, total: int):
        import numpy as np

        some = k > 0
        rest_below = np.maximum(1 - kb, 1e-12)
        with np.errstate(divide="ignore", invalid="ignore"):
            left = np.maximum(1 - (kc - DISCOUNT * k) / n, 1e-12)
            rest = n - kc
            gain = x - kc * np.log(n) + np.where(rest > 0, rest * np.log(rest / n / rest_below), 0.0)
            self.passed = np.where(some, np.log10(left / rest_below), np.nan)
            self.gain = some & (gain > 0.5 * math.log(max(2, total)) * k)


class Divided:
    """The divided contexts, numbered from 1 level by level; 0 is the root.
    ``keys`` of a level: the number of the parent and the oldest word, sorted."""

    def __init__(self, shares: int):
        import numpy as np

        self.keys: list = []
        self.firsts: list[int] = []
        self.level = self.parent = np.zeros(1, np.int64)
        self.shares = np.array([shares], np.int64)

    def add(self, keys, shares) -> None:
        import numpy as np

        order = np.argsort(keys)
        self.firsts.append(len(self.level))
        self.keys.append(keys[order])
        self.level = np.append(self.level, np.full(len(keys), len(self.keys)))
        self.parent = np.append(self.parent, keys[order] >> 32)
        self.shares = np.append(self.shares, shares[order])

    @property
    def starts(self):
        import numpy as np

        return np.cumsum(self.shares) - self.shares

    def above(self, s: int) -> list[int]:
        """The divided contexts of 1, 2, ... words that ``s`` ends with."""
        out = []
        while s:
            out.append(int(s))
            s = self.parent[s]
        return out[::-1]

    def chain(self, words: list) -> list:
        """For each level, the divided context of each token (0: none)."""
        import numpy as np

        last, out = None, []
        for d, (keys, first) in enumerate(zip(self.keys, self.firsts), 1):
            key = words[d] if last is None else last << 32 | words[d]
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = (keys[at] == key) & (words[d] > 0)
            last = np.where(hit if last is None else hit & (last > 0), first + at, 0)
            out.append(last)
        return out

    def dealt(self, words: list, texts) -> tuple:
        """The longest divided context of each token, and its part."""
        import numpy as np

        longest = np.zeros(len(texts), np.int64)
        for names in self.chain(words):
            longest = np.where(names > 0, names, longest)
        level = self.level[longest]
        before = np.zeros(len(texts), np.int64)
        for d in range(len(words) - 1):
            before = np.where(level == d, words[d + 1], before)
        # tokens without a word before have no context below
        by = np.where(before > 0, before, texts)
        return longest, self.starts[longest] + mixed(by) % self.shares[longest]


def pairs(key, **counts):
    """A record batch, by so many rows at a time, of a key in two halves."""
    import pyarrow as pa

    for i in range(0, len(key), ROWS):
        part = key[i:i + ROWS]
        yield pa.record_batch({"s": pa.array(part >> 32, pa.int64()), "x": pa.array(part & 0xFFFFFFFF, pa.int64()),
                               **{k: pa.array(v[i:i + ROWS], pa.int64()) for k, v in counts.items()}})


class Tree:
    """The suffix tree of coded chunks."""

    def __init__(self, texts: DataFrame, vocabulary: DataFrame, depth: int, share: float, common: float, part: int):
        n = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("c"), F.coalesce(F.sum("m"), F.lit(0)).alias("m"),
                           F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
        steps = vocabulary.groupBy("c").agg(F.min("id").alias("id")).collect()
        self.texts, self.depth = texts, depth
        self.total, self.tokens, self.least = n.c, n.m, max(1.0, share * n.c)
        self.root = Root([(r.id, r.c) for r in steps], n.c, n.v)
        self.limit = max(2, min(part, int(common * n.m)))
        self.divided = Divided(max(1, -(-n.m // part)))
        self.counts = None
        self.divide(vocabulary)
        self.settle()

    def divide(self, vocabulary: DataFrame) -> None:
        """Finds the contexts with ``limit`` tokens, and others with nearly so
        many.  A chunk leaves out what all chunks together have too seldom."""
        import numpy as np

        depth, divided = self.depth, self.divided
        found = vocabulary.filter(F.col("m") >= self.limit).select("id", "m").collect() if depth else []
        seldom = self.limit // (4 * max(1, self.texts.count())) if found else 0
        while found:
            keys, m = (np.array(x, np.int64) for x in zip(*found))
            divided.add(keys, -(-m // self.limit))
            d = len(divided.keys)
            if d == depth:
                break

            def run(batches: Iterator, d=d):
                for *_, words in read(batches, depth):
                    names = divided.chain(words)[-1]
                    at = (names > 0) & (words[d + 1] > 0)
                    key, m = np.unique(names[at] << 32 | words[d + 1][at], return_counts=True)
                    yield from pairs(key[m >= seldom], m=m[m >= seldom])

            rows = self.texts.mapInArrow(run, "s bigint, x bigint, m bigint").groupBy("s", "x").agg(F.sum("m").alias("m"))
            rows = rows.filter(F.col("m") >= 0.75 * self.limit)
            found = [(r.s << 32 | r.x, r.m) for r in rows.collect()]

    def settle(self) -> None:
        """Counts what follows the divided contexts and tests them."""
        import numpy as np

        depth, divided, root, least = self.depth, self.divided, self.root, self.least
        size = len(divided.level)
        self.n, self.passed, self.stays = np.zeros(size), np.full(size, np.nan), np.zeros(size, bool)
        if size == 1:
            return

        def run(batches: Iterator):
            for _, _, held, _, owner, words in read(batches, depth):
                for names in divided.chain(words):
                    at = (names > 0) & ~held[owner]
                    key, c = np.unique(names[at] << 32 | words[0][at], return_counts=True)
                    yield from pairs(key, c=c)

        self.counts = written(self.texts.mapInArrow(run, "s bigint, x bigint, c bigint").groupBy("s", "x")
                              .agg(F.sum("c").alias("c")), "divided-counts")
        for r in self.counts.groupBy("s").agg(F.sum("c").alias("n")).collect():
            self.n[r.s] = r.n
        n, parent = self.n, divided.parent

        def sums(batches: Iterator):
            import pyarrow as pa

            for b in batches:
                s, x, c, low = (b.column(k).to_numpy(zero_copy_only=False) for k in ("s", "x", "c", "low"))
                with np.errstate(divide="ignore", invalid="ignore"):
                    below = np.where(parent[s] == 0, root.p(x), (low - DISCOUNT) / n[parent[s]])
                kept = c >= least
                s, c, below = s[kept], c[kept], below[kept]
                each, s = np.unique(s, return_inverse=True)
                yield pa.record_batch({
                    "s": pa.array(each, pa.int64()), "k": pa.array(np.bincount(s, minlength=len(each)), pa.int64()),
                    "kc": pa.array(np.bincount(s, c, len(each)), pa.float64()),
                    "kb": pa.array(np.bincount(s, below, len(each)), pa.float64()),
                    "x": pa.array(np.bincount(s, c * (np.log(c) - np.log(below)), len(each)), pa.float64())})

        spark = self.texts.sparkSession
        parents = spark.createDataFrame([(i, int(p)) for i, p in enumerate(parent) if i], "s bigint, parent bigint")
        low = self.counts.select(F.col("s").alias("parent"), "x", F.col("c").alias("low"))
        rows = self.counts.join(F.broadcast(parents), "s").join(low, ["parent", "x"], "left")
        rows = (rows.select("s", "x", "c", F.coalesce("low", F.lit(0)).alias("low"))
                .mapInArrow(sums, "s bigint, k bigint, kc double, kb double, x double")
                .groupBy("s").agg(*(F.sum(c).alias(c) for c in ("k", "kc", "kb", "x"))).collect())
        k, kc, kb, x = np.zeros((4, size))
        for r in rows:
            k[r.s], kc[r.s], kb[r.s], x[r.s] = r.k, r.kc, r.kb, r.x
        test = Test(n, k, kc, kb, x, self.total)
        self.passed = test.passed
        self.keep(np.flatnonzero(test.gain))

    def keep(self, names) -> None:
        """These divided contexts stay, and their ancestors."""
        for s in names:
            while s and not self.stays[s]:
                self.stays[s] = True
                s = self.divided.parent[s]

    def deep(self, s: int) -> int:
        """How many words of a divided context are in the tree, as known."""
        return sum(bool(self.stays[i]) for i in self.divided.above(s))

    def moved(self) -> DataFrame:
        """``(part, s, chunk, d, blob, x, c)``: for each part the packed tokens
        of each chunk (``d`` is 0), and what follows the divided contexts of
        ``d`` words that its tokens have."""
        import numpy as np

        depth, divided, chosen = self.depth, self.divided, len(self.divided.level) > 1

        def run(batches: Iterator):
            import pyarrow as pa

            for chunk, _, held, _, owner, words in read(batches, depth):
                names, part = divided.dealt(words, chunk + owner)
                order = np.argsort(part, kind="stable")
                ends = np.flatnonzero(np.diff(part[order], append=-1)) + 1
                parts, contexts, blobs = [], [], []
                for i, j in zip(np.concatenate(([0], ends[:-1])), ends):
                    at = order[i:j]
                    parts.append(part[at[0]])
                    contexts.append(names[at[0]])
                    blobs.append(packed(*(w[at] for w in words), held[owner[at]].astype(np.int64), np.diff(owner[at], prepend=0)))
                yield pa.record_batch({"part": pa.array(parts, pa.int64()), "s": pa.array(contexts, pa.int64()),
                                       "chunk": pa.array(np.full(len(parts), chunk), pa.int64()),
                                       "blob": pa.array(blobs, pa.binary())})

        rows = self.texts.mapInArrow(run, "part bigint, s bigint, chunk bigint, blob binary").select(
            "part", "s", "chunk", F.lit(0).alias("d"), "blob", F.lit(0).cast("bigint").alias("x"), F.lit(0).cast("bigint").alias("c"))
        if not chosen:
            return rows

        def asked(batches: Iterator):
            for chunk, _, _, _, owner, words in read(batches, depth):
                names, part = divided.dealt(words, chunk + owner)
                at = names > 0
                yield from pairs(np.unique(part[at] << 32 | words[0][at]))

        starts = divided.starts
        spark = self.texts.sparkSession
        above = spark.createDataFrame(
            [(int(starts[s] + i), s, d, up) for s in range(1, len(starts)) for i in range(int(divided.shares[s]))
             for d, up in enumerate(divided.above(s), 1)], "part bigint, s bigint, d int, up bigint")
        wanted = (self.texts.mapInArrow(asked, "s bigint, x bigint").distinct()
                  .select(F.col("s").alias("part"), "x").join(F.broadcast(above), "part"))
        given = wanted.join(self.counts.select(F.col("s").alias("up"), "x", "c"), ["up", "x"])
        self.given = written(given.select("part", "s", F.lit(0).cast("bigint").alias("chunk"), "d",
                                          F.lit(None).cast("binary").alias("blob"), "x", "c"), "given")
        return rows.unionByName(self.given)

    def scores(self) -> DataFrame:
        """``(row, score)`` of the texts."""
        import numpy as np

        depth, divided, root, total, least = self.depth, self.divided, self.root, self.total, self.least
        n_of, passed_of, stays = self.n, self.passed, self.stays
        groups = max(1, -(-self.tokens // SUMMED))
        above = divided.above

        def run(table):
            import pyarrow as pa

            s = table.column("s")[0].as_py()
            chain = above(s)
            kind = table.column("d").to_numpy()
            own = table.filter(pa.array(kind == 0))
            parts = [unpacked(b.as_py()) for b in own.column("blob")]
            chunk = np.repeat(own.column("chunk").to_numpy(), [len(p[0]) for p in parts])
            text = chunk + np.concatenate([np.cumsum(p[-1]) for p in parts])
            group = mixed(chunk) % groups
            *words, held = (np.concatenate([p[i] for p in parts]) for i in range(depth + 2))
            del parts, chunk
            train = 1.0 - held
            xs, x = np.unique(words[0], return_inverse=True)
            p = root.p(xs)[x]
            logs, levels = [np.log10(p)], []
            at, context = np.arange(len(x)), np.zeros(len(x), np.int64)
            for d in range(1, depth + 1):
                if d <= len(chain):
                    up = chain[d - 1]
                    rows = table.filter(pa.array(kind == d))
                    after = np.zeros(len(xs))
                    after[np.searchsorted(xs, rows.column("x").to_numpy())] = rows.column("c").to_numpy()
                    after = after[x]
                    n, passed = n_of[up], passed_of[up]
                else:
                    there = words[d][at] > 0
                    at, context = at[there], context[there]
                    if not len(at):
                        break
                    key, context = np.unique(context << 32 | words[d][at], return_inverse=True)
                    grams, first, gram = np.unique(context * len(xs) + x[at], return_index=True, return_inverse=True)
                    c = np.bincount(gram, train[at], len(grams))
                    where, below = grams // len(xs), p[at[first]]
                    n = np.bincount(where, c, len(key))
                    kept = c >= least
                    where, below, some = where[kept], below[kept], c[kept]
                    test = Test(n, *(np.bincount(where, w, len(key)) for w in (
                        np.ones(len(some)), some, below, some * (np.log(some) - np.log(below)))), total)
                    levels.append((at, context, key >> 32, test.gain))
                    after, n, passed = c[gram], n[context], test.passed[context]
                with np.errstate(divide="ignore", invalid="ignore"):
                    own_p = (after - DISCOUNT) / n
                    log = logs[-1].copy()
                    log[at] = np.where(after >= least, np.log10(own_p), passed + log[at])
                    p = p.copy()
                    p[at] = np.where(after >= least, own_p, np.nan)
                logs.append(log)
            # ancestors of what stays also stay
            for (_, _, parent, gain), (_, _, _, higher) in zip(levels[:0:-1], levels[-2::-1]):
                higher[parent[gain]] = True
            child = bool(levels) and bool(levels[0][3].any())
            settled = not s or child or bool(stays[s])
            results = [(0, 0, logs[len(chain)])] if settled else [(s, d, logs[d]) for d in range(len(chain) + 1)]
            for d, (at, context, _, gain) in enumerate(levels, len(chain) + 1):
                deeper = at[gain[context]]
                results[0][2][deeper] = logs[d][deeper]
            texts, first, number = np.unique(text, return_index=True, return_inverse=True)
            group = group[first]
            out = {"to": [], "s": [], "d": [], "blob": []}
            for name, d, log in results:
                sums = np.bincount(number, log, len(texts))
                for g in np.unique(group).tolist():
                    these = texts[group == g]
                    blob = packed(np.diff(these, prepend=0), sums[group == g])
                    for k, v in zip(out, (g, name, d, blob)):
                        out[k].append(v)
            if s and child:
                for k, v in zip(out, (-1, s, 0, None)):
                    out[k].append(v)
            return pa.table({"to": pa.array(out["to"], pa.int64()), "s": pa.array(out["s"], pa.int64()),
                             "d": pa.array(out["d"], pa.int32()), "blob": pa.array(out["blob"], pa.binary())})

        sums = written(self.moved().groupBy("part").applyInArrow(run, "to bigint, s bigint, d int, blob binary"), "sums")
        if self.counts is not None:
            release(self.counts, self.given)
            self.keep([r.s for r in sums.filter("to < 0").select("s").distinct().collect()])
        deep = np.array([self.deep(s) for s in range(len(stays))])

        def added(table):
            import pyarrow as pa

            s, d = (table.column(k).to_numpy() for k in ("s", "d"))
            parts = [unpacked(b.as_py()) for b in table.filter(pa.array((s == 0) | (deep[s] == d))).column("blob")]
            texts, number = np.unique(np.concatenate([np.cumsum(p[0]) for p in parts]), return_inverse=True)
            score = np.bincount(number, np.concatenate([p[1].view(np.float64) for p in parts]), len(texts))
            return pa.table({"row": pa.array(texts, pa.int64()), "score": pa.array(score, pa.float64())})

        self.sums = sums
        return written(sums.filter("to >= 0").groupBy("to").applyInArrow(added, "row bigint, score double"), "scores")

    def rows(self) -> DataFrame:
        """``(doc_id, held_out, row, n_tokens, n_known, base_score)``."""
        depth, root = 0, self.root

        def run(batches: Iterator):
            import numpy as np
            import pyarrow as pa

            for chunk, ids, held, sizes, owner, words in read(batches, depth):
                known = root.count(words[0]) > 0
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(held), pa.array(chunk + np.arange(len(sizes)), pa.int64()), pa.array(sizes, pa.int64()),
                     pa.array(np.bincount(owner, known, len(sizes)).astype(np.int64)),
                     pa.array(np.bincount(owner, np.log10(root.p(words[0])), len(sizes)), pa.float64())],
                    ["doc_id", "held_out", "row", "n_tokens", "n_known", "base_score"])

        schema = (T.StructType().add("doc_id", self.texts.schema["ids"].dataType.elementType).add("held_out", T.BooleanType())
                  .add("row", T.LongType()).add("n_tokens", T.LongType()).add("n_known", T.LongType())
                  .add("base_score", T.DoubleType()))
        return self.texts.mapInArrow(run, schema)


def train_and_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS,
                    depth: int = DEPTH, share: float = SHARE, common: float = COMMON, chunk: int = CHUNK,
                    part: int = PART) -> DataFrame:
    """Learns from the documents outside of fold 0 and scores all: ``(doc_id,
    held_out, n_tokens, n_known, train_tokens, base_score, score)``, one row
    per document."""
    held_out = fold(F.col(id_col), folds) == 0
    with shuffles_deleted(docs.sparkSession):
        cut = chunks(docs.select(F.col(id_col).alias("doc_id"), held_out.alias("held_out"),
                                 F.col(text_col).cast("string").alias("text")), chunk)
        words = (cut.select(F.explode(F.arrays_zip("words", "m", "c")).alias("w"))
                 .groupBy(F.col("w.words").alias("word")).agg(F.sum("w.m").alias("m"), F.sum("w.c").alias("c")))
        ranked = numbered(words, [F.desc("c"), "word"], "id").withColumn("id", F.col("id") + 1)
        vocabulary = written(ranked, "vocabulary")
        texts = coded(cut, vocabulary.select("word", "id"))
        release(cut)
        tree = Tree(texts, vocabulary, depth, share, common, part)
        release(vocabulary)
        scores = tree.scores()
        release(tree.sums)
    return (tree.rows().join(scores, "row")
            .select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tree.total).cast("bigint").alias("train_tokens"),
                    "base_score", "score"))

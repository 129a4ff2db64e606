"""Phrase collocation mining by direct-address tiling.

Words get ids by language and falling frequency, texts become sequences of
ids, and adjacent ids are counted in tiles of ``SIDE x SIDE`` pairs.  As
frequent words have a language's smallest ids, few tiles hold most of the pairs:
a task counts those in dense arrays addressed by the pair itself
(``numpy.bincount``), at most ``DENSE`` of them, and the others as sorted
coordinates.  Frequent pairs
are ranked again, each text becomes the sequence of its pairs' ids, and the same
count of adjacent ids gives the phrases of three words, and so on: a phrase of
``k + 1`` words is frequent only if both of its parts of ``k`` words are.

Texts are cut into chunks of about ``CHUNK`` tokens, each with the dictionary
of its own words.  Ids reach a chunk by a join of its distinct words (then
pairs) with the ranked table, so no vocabulary is sent to the tasks, a frequent
word is one row a chunk, and memory is bounded by a chunk or one text.

The score of a phrase is the pointwise mutual information's argument, in
millionths and rounded down, for the cut into two parts that makes it smallest.
Products are decimals of 38 digits: exact for up to 10^15 occurrences.

Defined results: a null text is empty, a null language is ``und``.  Repeated
rows count each time.  Ties of score and count are ranked by the phrase's
UTF-8 bytes.  Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbering import numbered
from .common import release, written

#: Words of the longest phrase, occurrences of a candidate, percent of a
#: candidate's occurrences that a longer phrase takes over, phrases a language.
LONGEST, LEAST, SHARE, TOP = 3, 10, 50, 2000
#: Tokens in a chunk, ids along a tile, dense tiles in a task, tiles along the
#: square of the smallest ids in which dense ones are sought.
CHUNK, SIDE, DENSE, HEAD = 1 << 20, 512, 32, 32
#: Rows that a task passes on at a time.
ROWS = 1 << 16


def _table() -> bytes:
    change = {c: c + 32 for c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    change |= {c: ord(".") for c in b".,;:!?\n\x0b\x0c\r"} | {ord("\t"): ord(" ")}
    return bytes(change.get(c, c) for c in range(256))


TABLE = _table()


def tokens(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8, with ``.`` between its pieces."""
    return (text or "").encode("utf-8", "surrogatepass").translate(TABLE).replace(b".", b" . ").split()


def chunks(docs: DataFrame, lang_col: str, text_col: str, size: int) -> DataFrame:
    """``(chunk, lang, words, counts, codes)``: code ``i`` stands for the
    ``i``-th word, 0 for the end of a piece."""
    def run(batches):
        from array import array
        from collections import defaultdict

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        held: dict[str, tuple] = {}
        chunk = TaskContext.get().partitionId() << 32

        def row(lang):
            nonlocal chunk
            number, codes = held.pop(lang)
            codes = np.frombuffer(codes, np.int32)
            chunk += 1
            return pa.record_batch({
                "chunk": pa.array([chunk], pa.int64()), "lang": pa.array([lang], pa.string()),
                "words": pa.array([pa.array(list(number)[1:], pa.binary()).cast(pa.string())], pa.list_(pa.string())),
                "counts": pa.array([np.bincount(codes, minlength=len(number))[1:]], pa.list_(pa.int64())),
                "codes": pa.array([codes.tobytes()], pa.binary())})

        for b in batches:
            for lang, text in zip(*b.columns):
                lang = lang.as_py()
                if lang not in held:
                    number = defaultdict()
                    number.default_factory = number.__len__
                    number[b"."]
                    held[lang] = number, array("i")
                number, codes = held[lang]
                codes.extend(map(number.__getitem__, tokens(text.as_py())))
                codes.append(0)
                if len(codes) >= size:
                    yield row(lang)
        for lang in list(held):
            yield row(lang)

    narrow = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                         F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "chunk bigint, lang string, words array<string>, counts array<bigint>, codes binary")


def _packed(a) -> bytes:
    """Ids as 4 bytes each where they fit, else 8."""
    import numpy as np

    return a.astype(np.int32 if not len(a) or a.max() < 1 << 31 else np.int64, copy=False).tobytes()


def _ids(seq: bytes, n: int):
    import numpy as np

    return np.frombuffer(seq, np.int32 if len(seq) == 4 * n else np.int64)


def _adjacent(seq):
    """Ids side by side, and their places: 0 is none."""
    import numpy as np

    at = np.flatnonzero((seq[:-1] > 0) & (seq[1:] > 0))
    return seq[at].astype(np.int64), seq[at + 1].astype(np.int64), at


def _distinct(a, b, inverse: bool = False) -> tuple:
    """Distinct pairs in sorted order, and how often each occurs or (with
    ``inverse``) the number of each pair."""
    import numpy as np

    if not len(a) or max(a.max(), b.max()) < 1 << 31:
        key, more = np.unique(a << 32 | b, return_counts=not inverse, return_inverse=inverse)
        return key >> 32, key & 0xFFFFFFFF, more
    order = np.lexsort((b, a))
    new = np.ones(len(a), bool)
    new[1:] = (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)
    first = order[new]
    if not inverse:
        return a[first], b[first], np.diff(np.append(np.flatnonzero(new), len(a)))
    number = np.empty(len(a), np.int64)
    number[order] = np.cumsum(new) - 1
    return a[first], b[first], number


class Tiles:
    """Counts of pairs in a task: dense tiles are held to its end, the others
    come out chunk by chunk."""

    def __init__(self, side: int = SIDE, most: int = DENSE, head: int = HEAD):
        self.side, self.most, self.head, self.dense = side, most, head, {}

    def add(self, a, b):
        """Counts the pairs ``(a, b)`` of one language; those outside of dense
        tiles are returned as ``(a, b, n)``."""
        import numpy as np

        if not len(a):
            return a, b, a
        side, head = self.side, self.head
        # the square of tiles at the smallest id: the most frequent words of the language
        base = int(min(a.min(), b.min())) // side
        row, column = a // side - base, b // side - base
        tile = np.where((row < head) & (column < head), row * head + column, head * head)
        # a tile is worth an array if its pairs fill a sixteenth of it
        size = np.bincount(tile, minlength=head * head + 1)[:-1]
        sparse = np.ones(len(a), bool)
        for t in np.flatnonzero(size * 16 >= side * side).tolist():
            at = base + t // head, base + t % head
            if at in self.dense or len(self.dense) < self.most:
                part = tile == t
                counts = np.bincount(a[part] % side * side + b[part] % side, minlength=side * side)
                self.dense[at] = self.dense[at] + counts if at in self.dense else counts
                sparse &= ~part
        return _distinct(a[sparse], b[sparse])

    def rest(self):
        """``(a, b, n)`` of each dense tile."""
        import numpy as np

        for (i, j), counts in self.dense.items():
            cell = np.flatnonzero(counts)
            yield i * self.side + cell // self.side, j * self.side + cell % self.side, counts[cell]


def count_adjacent(coded: DataFrame, least: int, side: int = SIDE, dense: int = DENSE) -> DataFrame:
    """``(a, b, n)``: adjacent ids that occur ``least`` times."""
    def run(batches):
        import pyarrow as pa

        def rows(a, b, n):
            for i in range(0, len(a), ROWS):
                yield pa.record_batch({"a": pa.array(a[i:i + ROWS], pa.int64()), "b": pa.array(b[i:i + ROWS], pa.int64()),
                                       "n": pa.array(n[i:i + ROWS], pa.int64())})

        tiles = Tiles(side, dense)
        for batch in batches:
            for n, seq in zip(*batch.columns):
                yield from rows(*tiles.add(*_adjacent(_ids(seq.as_py(), n.as_py()))[:2]))
        for part in tiles.rest():
            yield from rows(*part)

    return (coded.select("n", "seq").mapInArrow(run, "a bigint, b bigint, n bigint")
            .groupBy("a", "b").agg(F.sum("n").alias("n")).filter(F.col("n") >= least))


def _given(coded: DataFrame, keys: DataFrame, on: list[str], ids: DataFrame) -> DataFrame:
    """``coded`` with ``places`` and ``ids`` of those of a chunk's ``keys``
    that have an id.  Chunks without any go: no phrase is there."""
    # the frequent ones are few beside all: they are hashed, the keys need no sort
    found = (keys.join(ids.hint("shuffle_hash"), on).groupBy("chunk")
             .agg(F.collect_list(F.struct("place", "id")).alias("found"))
             .select("chunk", F.col("found.place").alias("places"), F.col("found.id").alias("ids")))
    return coded.join(found, "chunk")


def _recoded(given: DataFrame, code) -> DataFrame:
    """``(chunk, n, seq)``: the new sequence of each chunk; ``code`` numbers
    the places of the present one."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for chunk, n, seq, places, ids in zip(*(b.column(c) for c in ("chunk", "n", "seq", "places", "ids"))):
                numbers = code(_ids(seq.as_py(), n.as_py()))
                name = np.zeros(int(numbers.max(initial=0)) + 1, np.int64)
                name[places.values.to_numpy()] = ids.values.to_numpy()
                yield pa.record_batch({"chunk": pa.array([chunk.as_py()], pa.int64()), "n": pa.array([len(numbers)], pa.int64()),
                                       "seq": pa.array([_packed(name[numbers])], pa.binary())})

    return given.mapInArrow(run, "chunk bigint, n bigint, seq binary")


def _pair_numbers(seq):
    """The number (from 1, in sorted order) of the pair that starts at each
    place but the last, 0 for none."""
    import numpy as np

    a, b, at = _adjacent(seq)
    out = np.zeros(max(0, len(seq) - 1), np.int64)
    out[at] = _distinct(a, b, inverse=True)[2] + 1
    return out


def _pairs_of(coded: DataFrame) -> DataFrame:
    """``(chunk, place, a, b)``: the distinct adjacent ids of a chunk."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for chunk, n, seq in zip(*batch.columns):
                a, b, _ = _distinct(*_adjacent(_ids(seq.as_py(), n.as_py()))[:2])
                for i in range(0, len(a), ROWS):
                    k = len(a[i:i + ROWS])
                    yield pa.record_batch({
                        "chunk": pa.array(np.full(k, chunk.as_py(), np.int64)),
                        "place": pa.array(np.arange(i + 1, i + k + 1, dtype=np.int32)),
                        "a": pa.array(a[i:i + k], pa.int64()), "b": pa.array(b[i:i + k], pa.int64())})

    return coded.select("chunk", "n", "seq").mapInArrow(run, "chunk bigint, place int, a bigint, b bigint")


def _ranked(rows: DataFrame, *by: str) -> DataFrame:
    """``rows`` with ``id`` from 1: by language, falling ``n``, and ``by``."""
    return numbered(rows, ["lang", F.desc("n"), *by], "id").withColumn("id", F.col("id") + 1)


def phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = LONGEST,
            least: int = LEAST, chunk: int = CHUNK, side: int = SIDE, dense: int = DENSE) -> tuple[list[DataFrame], DataFrame]:
    """Tables of the frequent phrases of 1, 2, ... words, and ``(lang, n)``
    of all words.  ``firsts`` and ``lasts`` of a phrase are the counts of its
    first and last 1, 2, ... words; ``a`` and ``b`` its parts but the last and
    but the first word."""
    cut = written(chunks(docs, lang_col, text_col, chunk), "chunks", compression="zstd")
    words = cut.select("chunk", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w"))
    counts = written(words.groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("n")), "word-counts")
    total = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    levels = [written(_ranked(counts.filter(F.col("n") >= least), "word").select(
        "lang", "id", "n", F.col("word").alias("phrase"), F.col("word").alias("last"),
        F.array("n").alias("firsts"), F.array("n").alias("lasts")), "phrases-1")]
    keys = words.select("chunk", "lang", (F.col("at") + 1).cast("int").alias("place"), F.col("w.words").alias("phrase"))
    given = _given(cut.select("chunk", (F.length("codes") / 4).cast("bigint").alias("n"), F.col("codes").alias("seq")),
                   keys, ["lang", "phrase"], levels[0].select("lang", "phrase", "id"))
    coded = written(_recoded(given, lambda seq: seq), "coded-1", compression="zstd")
    release(cut)
    for k in range(2, longest + 1):
        found = written(count_adjacent(coded, least, side, dense), "counts")
        front = levels[-1].select(F.col("id").alias("a"), "lang", F.col("phrase").alias("front"), "firsts")
        back = levels[-1].select(F.col("id").alias("b"), F.col("last").alias("last"), "lasts")
        joined = found.join(front, "a").join(back, "b").select(
            "lang", "n", F.concat_ws(" ", "front", "last").alias("phrase"), "last",
            F.concat("firsts", F.array("n")).alias("firsts"), F.concat("lasts", F.array("n")).alias("lasts"), "a", "b")
        levels.append(written(_ranked(joined, "a", "b"), f"phrases-{k}"))
        if k < longest:
            given = _given(coded, _pairs_of(coded), ["a", "b"], levels[-1].select("a", "b", "id"))
            last, coded = coded, written(_recoded(given, _pair_numbers), f"coded-{k}", compression="zstd")
            release(last)
    release(coded)
    return levels, total


def _score(a: str, l: Column, r: Column) -> Column:
    def exact(c):
        return c.cast("decimal(15,0)")
    a = exact(F.col(a))
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * a * a, exact(l) * exact(r))


def mine(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = LONGEST,
         least: int = LEAST, share: int = SHARE, top: int = TOP, chunk: int = CHUNK, side: int = SIDE,
         dense: int = DENSE) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of
    each language."""
    levels, total = phrases(docs, lang_col, text_col, longest, least, chunk, side, dense)
    kept = []
    for k in range(2, longest + 1):
        own = levels[k - 1]
        cuts = [F.struct(_score("n", F.col("firsts")[i - 1], F.col("lasts")[k - i - 1]).alias("score"), F.lit(i).alias("at"),
                         F.col("firsts")[i - 1].alias("l"), F.col("lasts")[k - i - 1].alias("r")) for i in range(1, k)]
        if k < longest:
            # the most frequent longer phrase around it is longer by one word
            longer = levels[k].select("n", F.explode(F.array("a", "b")).alias("id"))
            longer = longer.groupBy("id").agg(F.max("n").alias("longer"))
            own = own.join(longer, "id", "left").filter(
                F.coalesce(F.lit(100) * F.col("longer") < F.lit(share) * F.col("n"), F.lit(True)))
        best = cuts[0] if len(cuts) == 1 else F.least(*cuts)
        kept.append(own.select("lang", "phrase", F.col("n").alias("a"), best.alias("best"))
                    .select("lang", "phrase", "a", "best.l", "best.r", "best.score"))
    rows = reduce(DataFrame.unionByName, kept)
    rows = numbered(rows, [F.desc("score"), F.desc("a"), "phrase"], "rank", by=("lang",))
    rows = rows.withColumn("rank", F.col("rank") + 1).filter(F.col("rank") <= top)
    return rows.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

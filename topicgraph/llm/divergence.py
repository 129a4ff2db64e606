"""Source divergence audit by count-cell ranking.

How does the vocabulary of a source differ from that of its language, and
from that of each other source?  Every term gets a smoothed share
``p = 1 + floor(SCALE * (count + 1) / (N + V))`` in each (language, source)
group and in each language, and ``f = floor((p - q)^2 / q)`` compares two
shares.  ``p`` depends on a term only through its count, so ``f`` is evaluated
per *cell*, a pair of counts with the number of terms that have it:

* a group against its language: cells (group count, language count), equal
  values merged, ranked by cumulated multiplicity.  As every cell holds a term,
  the first ``top`` distinct values are enough; only their cells are expanded
  into terms;
* a group against another: cells (count here, count there).  Only terms that
  both have are paired, and a task merges the cells of many terms before they
  are shuffled; the terms that one or both lack follow from the groups' own counts, since
  ``sum f = V f(0,0) + sum_i (f(c,0) - f(0,0)) + sum_j (f(0,d) - f(0,0))
  + sum_both (f(c,d) - f(c,0) - f(0,d) + f(0,0))``.

Texts are counted where they lie: a task holds at most ``HELD`` counters and
then passes them on, so memory is bounded, and a hot source or a frequent term
reaches the shuffle as one row a task.  A term's counts in the sources of its
language are one row, no longer than that language's list of sources, whose
square the result has anyway.  All arithmetic is on integers.

Defined results: null text, language and source count as ''.  A group without
terms takes part with counts of 0; a language without kept terms has pairs of
value 0 and no term rows.  Repeated rows are documents of their own.  Ties of
values are ranked by the item's UTF-8 bytes.  An empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: A kept term is in so many documents of its language.
LEAST_DOCS = 3
#: Term rows a group.
TOP = 200
#: A share of one, in units.
SCALE = 1_000_000_000
#: Counters that a task holds before it passes them on.
HELD = 1 << 19
#: Pairs of counts that a task works on at a time.
STEP = 1 << 21
#: A term's documents are counted above its occurrences in one integer.
DOC = 1 << 44

COUNTS = "lang string, source string, term string, n bigint, docs bigint"


def _table() -> bytes:
    low = {c: c + 32 for c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    return bytes(low.get(c, c if c > 127 or c in low.values() else 32) for c in range(256))


TABLE = _table()


def terms(text: str | None) -> list[bytes]:
    """Runs of letters and of what is not ASCII, A-Z lower-cased, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(TABLE).split()


def count(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
          held: int = HELD) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences and documents of every
    term in every group; a null term has the documents of the group."""
    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        groups: dict[tuple, dict] = {}

        def rows():
            for (lang, source), seen in groups.items():
                both = np.fromiter(seen.values(), np.int64, len(seen))
                same = np.zeros(len(seen), np.int32)
                yield pa.record_batch({
                    "lang": pa.DictionaryArray.from_arrays(same, pa.array([lang], pa.string())).cast(pa.string()),
                    "source": pa.DictionaryArray.from_arrays(same, pa.array([source], pa.string())).cast(pa.string()),
                    "term": pa.array(list(seen), pa.binary()).cast(pa.string()),
                    "n": pa.array(both % DOC), "docs": pa.array(both // DOC)})
            groups.clear()

        size = 0
        for b in batches:
            for lang, source, t in zip(*b.columns):
                seen = groups.setdefault((lang.as_py(), source.as_py()), {})
                get, before = seen.get, len(seen)
                for w, n in Counter(terms(t.as_py())).items():
                    seen[w] = get(w, 0) + n + DOC
                seen[None] = get(None, 0) + DOC
                size += len(seen) - before
                if size > held:
                    yield from rows()
                    size = 0
        yield from rows()

    narrow = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    return (narrow.mapInArrow(run, COUNTS).groupBy("lang", "source", "term")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def share(n: Column | str, total: str, kept: str, scale: int = SCALE) -> Column:
    """``p`` of a count; null where no term is kept.  Decimals only where the
    product passes 64 bits."""
    n = F.col(n) if isinstance(n, str) else n
    every = F.nullif(F.col(total) + F.col(kept), F.lit(0))
    small = F.call_function("div", F.lit(scale).cast("bigint") * (n + 1), every)
    large = F.call_function("div", F.lit(scale).cast("decimal(10,0)") * (n + 1).cast("decimal(19,0)"), every.cast("decimal(19,0)"))
    return 1 + F.when(n < (1 << 62) // scale, small).otherwise(large)


def divergence(p: Column, q: Column) -> Column:
    """``f``: shares are at most 10^9 + 1, so the square fits 64 bits."""
    return F.call_function("div", (p - q) * (p - q), q)


def _terms(rows: DataFrame, groups: DataFrame, top: int, scale: int) -> DataFrame:
    """Each group's terms of the largest values above the language's share."""
    by = ["lang", "source"]
    cells = rows.groupBy(*by, "n", "lang_n").agg(F.count("*").alias("many")).join(groups, by)
    p, q = share("n", "total", "kept", scale), share("lang_n", "lang_total", "kept", scale)
    cells = written(cells.select(*by, "n", "lang_n", "many", p.alias("p"), q.alias("q")).filter("p > q")
                    .withColumn("value", divergence(F.col("p"), F.col("q"))), "cells")
    values = cells.groupBy(*by, "value").agg(F.sum("many").alias("many"))  # equal values merged
    order = Window.partitionBy(*by).orderBy(F.desc("value"))
    first = values.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top)
    above = F.sum("many").over(order.rowsBetween(Window.unboundedPreceding, -1))
    chosen = first.withColumn("above", F.coalesce(above, F.lit(0))).filter(F.col("above") < top)
    chosen = written(cells.join(chosen.select(*by, "value"), [*by, "value"]).select(*by, "n", "lang_n", "value"), "chosen")
    order = Window.partitionBy(*by).orderBy(F.desc("value"), "item")
    return (rows.join(chosen, [*by, "n", "lang_n"]).select(*by, F.lit("term").alias("part"), F.col("term").alias("item"), "value")
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top))


def _cells(rows: DataFrame, step: int = STEP) -> DataFrame:
    """``(lang, source, item, n, m, many)``: how many terms have the counts
    ``n`` and ``m``, above 0, in two sources of which the first is smaller."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            langs, counts = batch.column("lang"), batch.column("counts")
            size = counts.value_lengths().to_numpy().astype(np.int64)
            flat = counts.flatten()
            lang = langs.dictionary_encode()
            source = flat.field("source").dictionary_encode()
            names = source.dictionary
            s, n = source.indices.to_numpy().astype(np.int64), flat.field("n").to_numpy()
            la = np.repeat(lang.indices.to_numpy().astype(np.int64), size)
            # each entry is paired with those after it in its own list
            after = np.repeat(np.cumsum(size), size) - np.arange(len(s)) - 1
            cut = np.searchsorted(np.cumsum(after), np.arange(0, int(after.sum()), step)).tolist() + [len(s)]
            for lo, hi in zip(cut, cut[1:]):
                k = after[lo:hi]
                x = np.repeat(np.arange(lo, hi), k)
                y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(k) - k, k)
                keys = n[y], n[x], s[y], s[x], la[x]
                order = np.lexsort(keys)
                new = np.ones(len(order), bool)
                new[1:] = np.any([np.diff(c[order]) != 0 for c in keys], axis=0)
                at = np.flatnonzero(new)
                x, y = x[order[at]], y[order[at]]
                yield pa.record_batch({
                    "lang": lang.dictionary.take(pa.array(la[x])).cast(pa.string()), "source": names.take(pa.array(s[x])),
                    "item": names.take(pa.array(s[y])), "n": pa.array(n[x]), "m": pa.array(n[y]),
                    "many": pa.array(np.diff(np.append(at, len(order))))})

    counts = F.array_sort(F.collect_list(F.struct("source", "n"))).alias("counts")
    return (rows.groupBy("lang", "term").agg(counts).select("lang", "counts")
            .mapInArrow(run, "lang string, source string, item string, n bigint, m bigint, many bigint")
            .groupBy("lang", "source", "item", "n", "m").agg(F.sum("many").alias("many")))


def _pairs(rows: DataFrame, groups: DataFrame, scale: int) -> DataFrame:
    """``f`` of each group against each other of its language, summed."""
    def f(n: str | int, m: str | int) -> Column:
        n, m = (F.lit(x).cast("bigint") if isinstance(x, int) else F.col(x) for x in (n, m))
        return divergence(share(n, "total", "kept", scale), share(m, "other_total", "kept", scale))

    other = groups.select("lang", F.col("source").alias("item"), F.col("total").alias("other_total"))
    pairs = written(groups.select("lang", "source", "total", "kept").join(other, "lang")
                    .filter("source != item"), "source-pairs")
    own = written(rows.groupBy("lang", "source", "n").agg(F.count("*").alias("many")), "own-counts")
    here = pairs.join(own, ["lang", "source"])
    there = pairs.join(own.withColumnRenamed("source", "item"), ["lang", "item"])
    both = written(_cells(rows), "count-cells")
    both = both.select("lang", "many", F.inline(F.array(
        F.struct("source", "item", "n", "m"),
        F.struct(F.col("item").alias("source"), F.col("source").alias("item"), F.col("m").alias("n"), F.col("n").alias("m")))))
    both = both.join(pairs, ["lang", "source", "item"])

    parts = [(pairs.withColumn("many", F.col("kept")), f(0, 0)), (here, f("n", 0) - f(0, 0)), (there, f(0, "n") - f(0, 0)),
             (both, f("n", "m") - f("n", 0) - f(0, "m") + f(0, 0))]
    # summed in two halves: a value has up to 60 bits, and with its multiplicity more
    parts = [d.select("lang", "source", "item", "many", F.coalesce(v, F.lit(0)).alias("f"))
             .select("lang", "source", "item", (F.col("many") * F.shiftright("f", 32)).alias("high"),
                     (F.col("many") * F.col("f").bitwiseAND(0xFFFFFFFF)).alias("low")) for d, v in parts]
    value = F.sum("high").cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.sum("low").cast("decimal(20,0)")
    total = (reduce(DataFrame.unionByName, parts).groupBy("lang", "source", "item").agg(value.alias("value")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return total.select("lang", "source", F.lit("pair").alias("part"), "item", F.col("value").cast("bigint").alias("value"),
                        F.row_number().over(order).alias("rank"))


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
          least_docs: int = LEAST_DOCS, top: int = TOP, scale: int = SCALE, held: int = HELD) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: part ``term`` has each
    group's ``top`` terms, part ``pair`` every other source of the language."""
    counts = written(count(docs, lang_col, source_col, text_col, held), "term-counts")
    kept = (counts.filter("term IS NOT NULL").groupBy("lang", "term")
            .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).filter(F.col("docs") >= least_docs))
    kept = written(kept.select("lang", "term", "lang_n"), "kept-terms")
    rows = written(counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "kept-counts")
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    totals = rows.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = {"total": 0, "kept": 0, "lang_total": 0}
    groups = counts.filter("term IS NULL").select("lang", "source")
    groups = written(groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(zero), "groups")
    return _pairs(rows, groups, scale).unionByName(_terms(rows, groups, top, scale))

"""Line dedup with a log-template tree of fixed depth.

Every line goes down a tree of fixed depth: its number of tokens, then its
``LEAD`` first tokens, then the rest (after Drain; He et al., ICWS 2017).  Fields are
generalised in two ways.  A token with a digit is a field wherever it stands
(dates, counters, ids, addresses).  In a line of ``LONG`` tokens or more, the
tokens after the leading ones are cut into ``PARTS`` parts, and lines of one leaf
are one template if at least ``EQUAL`` of their parts are equal: fields may stand
in any of the others.  Candidates meet by equality: of the parts' ``GROUPS`` groups
at least one is equal as a whole.  Each such bucket has one representative, the
line (up to digits) that most documents have, then that which comes first; the
lines that are close enough to it are its template.  So a bucket gives a link for
each line, never its pairs.

A template that ``MIN_DOCS`` documents or more have recurs.  A line of
``PAIR_TOKENS`` tokens or ``PAIR_CHARS`` characters or more also recurs as it is
from ``PAIR_DOCS`` documents.  Lines of fewer than ``MIN_TOKENS`` tokens count
only as they are: from ``MIN_DOCS`` documents if they have ``SOME_CHARS``
characters, as lines of scripts without spaces do, and from ``SHORT_DOCS`` if they
have fewer.  Blank lines stay.  Of its templates a line takes the one that most
documents have (then its own, then a representative's, then that of the line as
it is; then the one whose first document is smaller).  The lines of a recurring
template are dropped, except in the first document that has it (smallest id),
so that a text of which there are copies stays once.

All of it is DataFrame functions.  Lines travel as hashes: of the leaf 64 bits,
of each part 32 more, so equal ones are equal lines at any size.  (line, document)
is combined before documents are counted, so a line that a third of the
documents have reaches the last count as a few rows, and only recurring
templates are joined back, by equality of written tables, whose large
partitions Spark splits.  The text moves once, to meet the numbers of the
lines that it loses.

Defined results: a null text has no line and stays null.  Rows that have the
same id and the same text are one document: they count once and lose the same
lines.  All rows with the first id keep the line, also if their texts differ.
A null id is never first: a template that only such rows have stays.  Repeats
of a line inside its first document stay.  An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, free_name, written

#: Leading tokens of a leaf; token count from which parts are generalised; parts,
#: those that must be equal, and groups of which one is equal then.
LEAD, LONG, PARTS, EQUAL = 3, 12, 8, 6
GROUPS = ((0, 3), (3, 6), (6, 8))
#: Documents of a template that recurs, and tokens of a line that may go.
MIN_DOCS, MIN_TOKENS = 3, 4
#: Documents of an exact line that recurs, and tokens or characters that it has.
PAIR_DOCS, PAIR_TOKENS, PAIR_CHARS = 2, 20, 120
#: Documents of a line that recurs though it has few tokens and fewer characters.
SHORT_DOCS, SOME_CHARS = 10, 20
FIELD = "<*>"
#: White space around a line.
ENDS = " \t\n\x0b\f\r"
#: What a row says a line is: itself up to digits, or as it is.
SHAPE, EXACT = 0, 1
KEY = ["kind", "n", "lead", "parts"]


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def tokens(trimmed: Column) -> Column:
    """Tokens of a line without white space around it, each with a digit
    replaced by the field sign."""
    # from the start of a token, without stepping back: one pass over the line
    field = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
    masked = F.when(trimmed.rlike("[0-9]"), F.regexp_replace(trimmed, field, FIELD)).otherwise(trimmed)
    return F.split(masked, SPACE + "+")


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with ``value`` worked out once."""
    return F.get(F.transform(F.array(value), f), 0)


def shapes_of(toks: Column, trimmed: Column, min_tokens: int, min_docs: int) -> Column:
    """What a line counts as: ``(kind, n, lead, parts, need)``, its place in the
    tree with the documents it needs there."""
    n = F.size(toks)

    def said(kind, lead, parts, need):
        return F.struct(F.lit(kind).alias("kind"), n.alias("n"), F.xxhash64(lead).alias("lead"),
                        parts.alias("parts"), F.lit(need).cast("int").alias("need"))

    def one(c):
        return F.array(F.hash(c))

    start = [(LEAD + 1 + F.floor((n - LEAD) * i / PARTS)).cast("int") for i in range(PARTS)] + [n + 1]
    parts = F.array(*[F.hash(F.slice(toks, start[i], start[i + 1] - start[i])) for i in range(PARTS)])
    few = F.when(F.length(trimmed) >= SOME_CHARS, min_docs).otherwise(max(min_docs, SHORT_DOCS))
    itself = said(EXACT, trimmed, one(trimmed), F.when(n < min_tokens, few).otherwise(PAIR_DOCS))
    pair = said(EXACT, trimmed, one(trimmed), PAIR_DOCS)
    shape = (F.when(n >= LONG, said(SHAPE, F.slice(toks, 1, LEAD), parts, min_docs))
             .otherwise(said(SHAPE, toks, one(toks), min_docs)))
    long = (n >= PAIR_TOKENS) | (F.length(trimmed) >= PAIR_CHARS)
    return (F.when(trimmed == "", F.array().cast("array<struct<kind:int,n:int,lead:bigint,parts:array<int>,need:int>>"))
            .when(n < min_tokens, F.array(F.when(long, pair).otherwise(itself)))
            .when(long, F.array(shape, pair)).otherwise(F.array(shape)))


def shape_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_tokens: int = MIN_TOKENS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(doc_id, h, line, kind, n, lead, parts, need)``: what each line counts
    as.  ``(doc_id, h)`` names a document, by its id and a hash of its text."""
    each = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("h"),
                       F.posexplode(lines(F.col(text_col))).alias("line", "raw"))
    found = bound(F.trim(F.col("raw"), F.lit(ENDS)), lambda trimmed: bound(
        tokens(trimmed), lambda toks: shapes_of(toks, trimmed, min_tokens, min_docs)))
    return written(each.filter(F.trim("raw", F.lit(ENDS)) != "").select("doc_id", "h", "line", F.inline(found)), "parsed-lines")


def recurring(rows: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(kind, n, lead, parts, docs, first)``: the template that lines of each
    shape take, if it recurs; ``first`` is the smallest id that has it."""
    # nulls are never first; the line number tells representatives of one document apart
    at = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "line"))
    per_doc = rows.groupBy(*KEY, "need", "doc_id", "h").agg(F.min("line").alias("line"))
    shapes = written(per_doc.groupBy(*KEY, "need").agg(F.count("*").alias("docs"), at.alias("at")), "shapes")
    known = shapes.filter(F.col("docs") >= F.col("need")).select(
        *KEY, "docs", F.col("at.doc_id").alias("first"), F.when(F.col("kind") == SHAPE, 0).otherwise(2).alias("rank"))

    leaf = ["n", "lead"]
    groups = F.array(*[F.slice("parts", a + 1, b - a) for a, b in GROUPS])
    placed = (shapes.filter((F.col("kind") == SHAPE) & (F.col("n") >= LONG))
              .select(*leaf, "parts", "docs", "at", F.posexplode(groups).alias("g", "key")))
    bucket = [*leaf, "g", "key"]
    first = F.min_by("parts", F.struct(-F.col("docs"), "at"))
    reps = written(placed.groupBy(*bucket).agg(first.alias("rep"), F.count("*").alias("many"))
                   .filter("many > 1").drop("many"), "representatives")
    same = F.size(F.filter(F.zip_with("parts", "rep", lambda x, y: x == y), lambda e: e))
    close = placed.select(*bucket, "parts").join(reps, bucket).filter(same >= EQUAL).select(*leaf, "parts", "rep").distinct()
    # a representative that only itself is close to says nothing new
    more = close.groupBy(*leaf, "rep").agg(F.count("*").alias("many")).filter("many > 1").drop("many")
    close = written(close.join(more, [*leaf, "rep"], "left_semi"), "close-lines")
    theirs = rows.filter(F.col("kind") == SHAPE).select(*leaf, "parts", "doc_id", "h").join(close, [*leaf, "parts"])
    wide = (theirs.select(*leaf, "rep", "doc_id", "h").distinct().groupBy(*leaf, "rep")
            .agg(F.count("*").alias("docs"), F.min("doc_id").alias("first")).filter(F.col("docs") >= min_docs))
    wide = close.join(wide, [*leaf, "rep"]).select(F.lit(SHAPE).alias("kind"), *leaf, "parts", "docs", "first", F.lit(1).alias("rank"))
    best = F.min_by(F.struct("docs", "first", "rank"), _order()).alias("best")
    return known.unionByName(wide).groupBy(*KEY).agg(best).select(*KEY, "best.*")


def _order() -> Column:
    return F.struct(-F.col("docs"), F.col("rank"), F.col("first").isNull(), F.col("first"))


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                  min_tokens: int = MIN_TOKENS) -> DataFrame:
    """``(doc_id, h, drop)``: the numbers of the lines that a document loses."""
    rows = shape_rows(docs, id_col, text_col, min_tokens, min_docs)
    common = written(recurring(rows, min_docs), "templates")
    line = (rows.join(common, KEY).groupBy("doc_id", "h", "line").agg(F.min_by("first", _order()).alias("first")))
    gone = line.filter(F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("doc_id")))
    return gone.groupBy("doc_id", "h").agg(F.array_sort(F.collect_set("line")).alias("drop"))


def mask(drop: Column) -> Column:
    """One flag for each line up to the last in ``drop`` (sorted numbers), so
    that a line's test takes one step however many lines go."""
    def upto(x, i):
        return F.concat(F.repeat(F.lit("0"), x - F.coalesce(F.get(drop, i - 1), F.lit(-1)) - 1), F.lit("1"))

    return F.transform(F.split(F.array_join(F.transform(drop, upto), ""), ""), lambda c: c == "1")


def drop_templates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                   min_tokens: int = MIN_TOKENS, lost: str = "n_dropped") -> DataFrame:
    """``docs`` with the recurring lines taken out of the texts, and the
    column ``lost``: how many."""
    h, other_id, other_h, gone = (free_name(docs, c) for c in ("text_hash", "drop_id", "drop_hash", "dropped"))
    drop = written(dropped_lines(docs, id_col, text_col, min_docs, min_tokens), "dropped-lines")
    drop = drop.select(F.col("doc_id").alias(other_id), F.col("h").alias(other_h), mask(F.col("drop")).alias(gone))
    met = docs.withColumn(h, F.xxhash64(F.col(text_col))).join(
        drop, F.col(id_col).eqNullSafe(F.col(other_id)) & (F.col(h) == F.col(other_h)), "left")
    kept = F.array_join(F.filter(lines(F.col(text_col)),
                                 lambda x, i: ~F.coalesce(F.get(F.col(gone), i), F.lit(False))), "\n")
    text = F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(kept)
    n = F.when(F.col(gone).isNull(), 0).otherwise(F.size(F.filter(F.col(gone), lambda g: g)))
    return met.select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns],
                      n.cast("bigint").alias(lost))


def summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_dropped, n_kept, text_sha256)`` of every document."""
    out = drop_templates(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    text = F.coalesce("text", F.lit(""))
    total = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines(text)))
    kept = F.when(F.col("text").isNull() | ((F.col("text") == "") & (F.col("n_dropped") > 0)), 0).otherwise(total)
    return out.select("doc_id", "n_dropped", kept.cast("bigint").alias("n_kept"),
                      F.sha2(text.cast("binary"), 256).alias("text_sha256"))

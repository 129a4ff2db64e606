"""Secret scan with corpus-wide ownership frequency.

Patterns find candidates and their places in every text.  Whether a
candidate is a live credential cannot be seen in one text: an example that a
tutorial prints is copied everywhere, a real key is found at its owner only.
So each candidate's hash is counted over the whole corpus by distinct
repositories and owners.  A value of ``WIDE`` owners or more is an example;
one of a single owner that also looks random is live-looking; the rest is
unclear.  The contract's base kinds are reported in any case; further kinds
are added only where the frequency says that they are live-looking.

All of it is DataFrame functions.  A text leaves the scan as the lengths
between matches and the matches; places are running sums over those small
rows.  Hashes are combined by (hash, owner, repository) before they are
counted, so a value that a third of the rows share reaches the last count as
a few rows; the counts are written and joined back by hash, a plain
equi-join whose large partitions Spark splits.

Defined results: a null text counts as empty.  Null owners or repositories
count as one owner or repository.  Repeated rows stay as rows; they change no
count of owners.  A document without candidates has zero counts and empty
spans.  Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Owners from which on a value is a widely copied example.
WIDE = 3
#: Different characters, as a share of the length up to 16, of a value that looks random.
RANDOM = 0.4
#: Kinds in the order of the contract with their patterns, the
#: group that holds the value, and the least length of that group.
BASE = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
#: Kinds that are reported only when they are live-looking.
ADDED = {
    "key": (r"\b(?:gh[pousr]_|glpat-|sk-|xox[abprs]-|AIza)[A-Za-z0-9_-]{16,}", 0, 20),
    "jwt": (r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 28),
    "mixed": (r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]{24})(?=[a-z0-9+/_-]*[A-Z])(?=[A-Z0-9+/_-]*[a-z])"
              r"(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]+", 0, 24),
}
KINDS = [*BASE, *ADDED]


def _hits(text: Column, kind: str) -> Column:
    """Matches of one kind: number, length of the text before (since the last
    match), length, value."""
    pattern, group, _ = (BASE | ADDED)[kind]
    p = F.lit(pattern)
    whole = F.regexp_extract_all(text, p, F.lit(0))
    parts = F.arrays_zip(whole.alias("m"), F.split(text, pattern, -1).alias("gap"),
                         (whole if group == 0 else F.regexp_extract_all(text, p, F.lit(group))).alias("value"))
    found = F.transform(F.slice(parts, 1, F.size(whole)), lambda x, i: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), i.alias("i"), F.length(x["gap"]).alias("gap"),
        F.length(x["m"]).alias("len"), x["value"].alias("value")))
    return F.when(text.rlike(pattern), found)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
               repository: Column | None = None) -> DataFrame:
    """``(row, doc_id, owner, repository, hits)`` of every document."""
    repository = F.col(owner_col) if repository is None else repository
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                         F.col(owner_col).cast("string").alias("owner"), repository.cast("string").alias("repository"))
    none = F.array().cast("array<struct<kind:int,i:int,gap:int,len:int,value:string>>")
    hits = F.concat(*[F.coalesce(_hits(F.col("text"), k), none) for k in KINDS])
    return written(narrow.select(F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "repository",
                                 hits.alias("hits")), "secret-candidates")


def places(found: DataFrame) -> DataFrame:
    """``(row, owner, repository, kind, start, end, value, hash)``: code
    points, end exclusive; matches whose value is too short are dropped."""
    each = found.select("row", "owner", "repository", F.explode("hits").alias("h")).select(
        "row", "owner", "repository", "h.*")
    so_far = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("len")).over(so_far)
    least = F.element_at(F.array(*[F.lit(n) for _, _, n in (BASE | ADDED).values()]), F.col("kind") + 1)
    return (each.withColumn("end", end).filter(F.length("value") >= least)
            .select("row", "owner", "repository", "kind", (F.col("end") - F.col("len")).alias("start"), "end", "value",
                    F.unhex(F.sha2("value", 256)).alias("hash")))


def ownership(spans: DataFrame) -> DataFrame:
    """``(hash, n_owners, n_repositories)`` over the whole corpus."""
    pairs = spans.groupBy("hash", F.coalesce("owner", F.lit("")).alias("owner"),
                          F.coalesce("repository", F.lit("")).alias("repository")).agg(F.count("*").alias("n"))
    owners = pairs.groupBy("hash", "owner").agg(F.count("*").alias("k"))
    return owners.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("k").alias("n_repositories"))


def verdict(value: Column, n_owners: Column) -> Column:
    chars = F.size(F.array_distinct(F.split(value, "")))
    random = chars >= F.lit(RANDOM) * F.least(F.length(value), F.lit(16))
    return (F.when(n_owners >= WIDE, "example").when(random & (n_owners == 1), "live").otherwise("unclear"))


def classified(spans: DataFrame, wide: int = WIDE) -> DataFrame:
    """The spans with ``n_owners``, ``n_repositories`` and ``verdict``;
    added kinds only where they are live-looking."""
    counts = written(ownership(spans), "secret-owners")
    told = spans.join(counts, "hash").withColumn("verdict", verdict(F.col("value"), F.col("n_owners")))
    return told.filter((F.col("kind") < len(BASE)) | (F.col("verdict") == "live"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         repository: Column | None = None) -> DataFrame:
    """``(doc_id, found)``, one row per document; ``found`` is the array of
    its spans in order: start, kind, end, verdict, n_owners, n_repositories."""
    hits = candidates(docs, id_col, text_col, owner_col, repository)
    spans = classified(places(hits))
    one = F.struct("start", "kind", "end", "verdict", "n_owners", "n_repositories")
    per_doc = spans.groupBy("row").agg(F.array_sort(F.collect_list(one)).alias("found"))
    kind = "array<struct<start:bigint,kind:int,end:bigint,verdict:string,n_owners:bigint,n_repositories:bigint>>"
    return (hits.select("row", "doc_id").join(per_doc, "row", "left")
            .select("doc_id", F.coalesce("found", F.array().cast(kind)).alias("found")))


def span_list(found: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def report(found: DataFrame) -> DataFrame:
    """Counts and digests of ``scan``'s rows."""
    def n(test):
        return F.size(F.filter("found", test)).cast("bigint")

    def of_kind(i):
        return lambda s: s["kind"] == i

    base = F.filter("found", lambda s: s["kind"] < len(BASE))
    return found.select(
        "doc_id", *[n(of_kind(i)).alias(f"n_{k}") for i, k in enumerate(BASE)],
        F.sha2(span_list(base), 256).alias("base_sha256"), span_list(F.col("found")).alias("spans"),
        n(lambda s: s["verdict"] == "live").alias("n_live"), n(lambda s: s["verdict"] == "example").alias("n_example"))

"""Stored search index: X3, P4-P7, A14, T4 and R1 without reading messages.

Four parquet tables under one folder:

``documents``  (block, doc_id, dl, the other columns of the input): documents
               numbered by (length, id) and cut into blocks of ``BLOCK``;
``postings``   (token, block, n, max_norm, min_doc, max_time, docs): one row
               holds a token's postings in one block, with positions, and the
               largest impact among them; sorted by (token, block), so a
               filter on the token skips files and row groups;
``terms``      (token, df, tf, blocks): the dictionary, sorted by token;
``stats``      (n_docs, avgdl): documents that have terms, their mean length.

All tokens share the blocks, so the impacts of a query's terms in a block add
up to a bound of every score in it.  ``top`` reads the blocks with the largest
bounds, and then only those that can still hold one of the best ``k``: a block
whose bound ties with the ``k``-th score counts only if it may hold a smaller
id.  Documents of one length lie side by side, because the impact of a token
falls with the length: so bounds are close to the scores.

Synonyms are postings without positions of the emoji that they expand (index-time
expansion), so a topic's own tokens are looked up as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..functions.numbering import numbered
from ..session import delete, scratch_path, shuffles_deleted, written
from .search import _EXPLAIN_SCHEMA, B, K1, _ts, token_tasks

#: Documents in a block, and blocks that ``top`` reads before bounds decide.
BLOCK, FIRST = 4096, 8
#: Scores and bounds are sums in different orders: they differ by less.
MARGIN = 1e-9


def _norm(tf: Column, dl: Column, avgdl: Column) -> Column:
    return tf * F.lit(K1 + 1) / (tf + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * dl / avgdl))


def build(docs: DataFrame, path: str, doc_id: str = "doc_id", message: str = "message", time: str = "time_sended",
          tokens: str | None = None, block: int = BLOCK, synonyms: bool = True,
          emoticons: dict[str, str] | None = None, synonym_rows: text.Synonyms | None = None) -> "SearchIndex":
    """Writes the index of ``docs`` (unique ``doc_id``, ``message``, ``time``;
    other columns are kept in ``documents``) to ``path``.  ``tokens`` names a
    stored token column, else the messages are analysed."""
    spark = docs.sparkSession
    rest = [c for c in docs.columns if c not in (doc_id, message, time, tokens)]
    base = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(message).alias("message"),
                       F.col(time).alias("time_sended"), *rest, *([F.col(tokens).alias("tokens")] if tokens else []))
    if not tokens:
        base = base.select("*", F.inline(F.array(F.struct(text.analyze("message", emoticons).alias("tokens")))))
    base = base.withColumn("tokens", F.coalesce("tokens", F.array().cast("array<string>"))).withColumn("dl", F.size("tokens"))
    ranges = scratch_path(spark, "numbered")
    with written(base, "analysed") as base, shuffles_deleted(spark):  # analysed once: dealing by ranges reads its rows twice
        rows = numbered(base, ["dl", "doc_id"], "number", path=ranges)
    with shuffles_deleted(spark):
        # numbered rows lie in ranges of their number already: a map-side write keeps them sorted
        rows = rows.withColumn("block", F.expr(f"number div {int(block)}")).drop("number")
        rows.sortWithinPartitions("block", "doc_id").write.option("compression", "zstd").parquet(f"{path}/documents")
        delete(spark, ranges)
        _write_postings(spark, path, synonyms, synonym_rows)
    return SearchIndex(spark, path, synonyms, emoticons, synonym_rows)


def _write_postings(spark: SparkSession, path: str, synonyms: bool, synonym_rows: text.Synonyms | None) -> None:
    stored = spark.read.parquet(f"{path}/documents")
    (stored.filter("dl > 0").agg(F.count("*").alias("n_docs"), F.avg("dl").alias("avgdl"))
     .write.parquet(f"{path}/stats"))
    stats = spark.read.parquet(f"{path}/stats")

    key = ["block", "doc_id", "dl", "time_sended"]
    said = text.token_table(stored, key, "tokens", synonyms, synonym_rows)
    # ranges of (token, block): a frequent token is spread over tasks, each of its rows has at most one block
    tasks = token_tasks(stored)
    said = said.repartitionByRange(tasks, "token", "block") if tasks else said.repartitionByRange("token", "block")
    place = F.collect_list(F.when(~F.col("synonym"), F.col("pos")))
    each = said.groupBy("token", *key).agg(F.count("*").cast("int").alias("tf"), F.array_sort(place).alias("positions"))
    each = each.crossJoin(F.broadcast(stats))  # one row
    each = each.withColumn("norm", _norm(F.col("tf"), F.col("dl"), F.col("avgdl")))
    doc = F.struct("doc_id", "time_sended", "dl", "tf", "positions")
    (each.groupBy("token", "block").agg(
        F.count("*").cast("int").alias("n"), F.max("norm").alias("max_norm"), F.min("doc_id").alias("min_doc"),
        F.max("time_sended").alias("max_time"), F.sum("tf").alias("tf"), F.collect_list(doc).alias("docs"))
     .sortWithinPartitions("token", "block").write.option("parquet.block.size", 8 << 20).option("compression", "zstd")
     .parquet(f"{path}/postings"))
    heads = spark.read.parquet(f"{path}/postings")
    (heads.groupBy("token").agg(F.sum("n").alias("df"), F.sum("tf").alias("tf"), F.count("*").alias("blocks"))
     .repartitionByRange("token").sortWithinPartitions("token").write.parquet(f"{path}/terms"))


def _after(prefix: str) -> str | None:
    """The smallest string above all that start with ``prefix``."""
    while prefix:
        last = ord(prefix[-1])
        if last < 0x10FFFF:
            return prefix[:-1] + chr(0xE000 if last == 0xD7FF else last + 1)
        prefix = prefix[:-1]
    return None


@dataclass
class SearchIndex:
    """A stored index; build it with ``build`` and open it with its path."""

    spark: SparkSession
    path: str
    synonyms: bool = True
    emoticons: dict[str, str] | None = None
    synonym_rows: text.Synonyms | None = None

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    @property
    def documents(self) -> DataFrame:
        return self._table("documents")

    @property
    def terms(self) -> DataFrame:
        """A14 and the dictionary: ``(token, df, tf, blocks)``."""
        return self._table("terms")

    @property
    def stats(self) -> DataFrame:
        return self._table("stats")

    def _analysed(self, topic: str) -> list[str]:
        return text.analyze_text(topic, self.emoticons)

    def _expanded(self, topic: str) -> list[str]:
        q = self._analysed(topic)
        return list(dict.fromkeys(text.expand(q, self.synonym_rows) if self.synonyms else q))

    def _postings(self, tokens: list[str] | Column, t0=None, t1=None) -> DataFrame:
        """``(token, block, doc_id, time_sended, dl, tf, positions)`` of the
        tokens (a short list, or a condition on ``token``)."""
        wanted = F.col("token").isin(tokens) if isinstance(tokens, list) else tokens
        rows = self._table("postings").filter(wanted)
        if t0 is not None:
            rows = rows.filter(F.col("max_time") >= _ts(t0))
        rows = rows.select("token", "block", F.inline("docs"))
        if t0 is not None:
            rows = rows.filter(F.col("time_sended") >= _ts(t0))
        return rows if t1 is None else rows.filter(F.col("time_sended") <= _ts(t1))

    # Which documents match -----------------------------------------

    def _found(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("doc_id").agg(F.first("time_sended").alias("time_sended"))

    def match(self, topic: str, t0=None, t1=None) -> DataFrame:
        """``(doc_id, time_sended)`` of documents with a token of the topic."""
        return self._found(self._postings(self._expanded(topic), t0, t1))

    def term(self, token: str, t0=None, t1=None) -> DataFrame:
        """P5: the raw token must be one of the document's."""
        return self._found(self._postings([token], t0, t1))

    def prefix(self, prefix: str, t0=None, t1=None) -> DataFrame:
        """P5: a token that starts with ``prefix``: a range of the sorted
        dictionary, which is also a range of the postings."""
        end = _after(prefix)
        wanted = F.col("token") >= prefix
        return self._found(self._postings(wanted if end is None else wanted & (F.col("token") < end), t0, t1))

    def phrase(self, topic: str, t0=None, t1=None) -> DataFrame:
        """P5: the topic's base tokens stand side by side.  A place of the
        ``i``-th token is a start ``i`` places before; a document matches where
        all tokens agree on one start.  Blocks without one of them are not
        expanded."""
        q = self._analysed(topic)
        if not q:
            return self._postings(F.lit(False)).select("doc_id", "time_sended")
        offsets: dict[str, list[int]] = {}
        for i, t in enumerate(q):
            offsets.setdefault(t, []).append(i)
        if len(offsets) > 1:
            heads = self._table("postings").filter(F.col("token").isin(list(offsets)))
            whole = heads.groupBy("block").agg(F.count("*").alias("k")).filter(F.col("k") == len(offsets)).select("block")
            rows = self._postings(list(offsets), t0, t1).join(whole, "block", "left_semi")
        else:
            rows = self._postings(list(offsets), t0, t1)
        places = F.lit(None)
        for t, at in offsets.items():
            places = F.when(F.col("token") == t, F.array(*[F.lit(i) for i in at])).otherwise(places)
        starts = (rows.select("doc_id", "time_sended", F.explode("positions").alias("pos"), places.alias("offsets"))
                  .select("doc_id", "time_sended", "pos", F.explode("offsets").alias("offset")))
        all_of = starts.groupBy("doc_id", "time_sended", (F.col("pos") - F.col("offset")).alias("start")).agg(
            F.count("*").alias("k")).filter(F.col("k") == len(q))
        return self._found(all_of)

    # The best documents --------------------------------------------

    def _scored(self, rows: DataFrame, terms: list[str], known: dict, n_docs: int, avgdl: float) -> DataFrame:
        """One row per document, with its explanation and score."""
        idf = F.lit(None).cast("double")
        df = F.lit(None).cast("bigint")
        order = F.lit(None).cast("int")
        for i, t in enumerate(terms):
            n = F.lit(float(known[t]))
            value = F.log(F.lit(1.0) + (F.lit(float(n_docs)) - n + F.lit(0.5)) / (n + F.lit(0.5)))
            idf = F.when(F.col("token") == t, value).otherwise(idf)
            df = F.when(F.col("token") == t, F.lit(known[t]).cast("bigint")).otherwise(df)
            order = F.when(F.col("token") == t, F.lit(i)).otherwise(order)
        norm = _norm(F.col("tf"), F.col("dl"), F.lit(avgdl))
        part = F.struct(
            order.alias("at"), F.col("token").alias("term"), F.col("tf").cast("bigint").alias("tf"), df.alias("df"),
            F.lit(n_docs).cast("bigint").alias("n_docs"), F.col("dl").cast("bigint").alias("dl"),
            F.lit(avgdl).alias("avgdl"), idf.alias("idf"), norm.alias("tf_norm"), (idf * norm).alias("score"))
        each = rows.groupBy("doc_id").agg(
            F.first("block").alias("block"), F.first("time_sended").alias("time_sended"),
            F.array_sort(F.collect_list(part)).alias("parts"))
        names = ["term", "tf", "df", "n_docs", "dl", "avgdl", "idf", "tf_norm", "score"]
        expl = F.transform("parts", lambda p: F.struct(*[p[c].alias(c) for c in names]))
        each = each.select("doc_id", "block", "time_sended", expl.alias("explanation"))
        return each.withColumn("score", F.aggregate("explanation", F.lit(0.0), lambda a, s: a + s["score"]) + F.lit(1.0))

    def _bounds(self, terms: list[str], idfs: dict[str, float], t0) -> DataFrame:
        """``(block, bound, min_doc)`` of the blocks that hold a term."""
        idf = F.lit(0.0)
        for t in terms:
            idf = F.when(F.col("token") == t, F.lit(idfs[t])).otherwise(idf)
        heads = self._table("postings").filter(F.col("token").isin(terms))
        if t0 is not None:
            heads = heads.filter(F.col("max_time") >= _ts(t0))
        return heads.groupBy("block").agg((F.sum(idf * F.col("max_norm")) + F.lit(1.0)).alias("bound"),
                                          F.min("min_doc").alias("min_doc"))

    def top(self, topic: str, t0=None, k: int = 10, first: int = FIRST, read: list | None = None) -> DataFrame:
        """The ``k`` best documents for ``match(topic) AND time >= t0``
        with an explanation, as ``search.explained_search`` gives them.
        ``read`` (a list) gets the numbers of blocks read and not read."""
        from .search import idf as idf_of

        stats = self.stats.first()
        known = {r.token: r.df for r in self.terms.filter(F.col("token").isin(self._expanded(topic))).collect()}
        terms = [t for t in self._expanded(topic) if t in known]
        if not terms or not stats.n_docs:
            return self.spark.createDataFrame([], _EXPLAIN_SCHEMA)
        best = [F.desc("score"), F.asc("doc_id")]
        bounds = self._bounds(terms, {t: idf_of(stats.n_docs, known[t]) for t in terms}, t0)
        chosen = [r.block for r in bounds.orderBy(F.desc("bound"), "min_doc").limit(first).collect()]

        def scored(rows):
            return self._scored(rows, terms, known, stats.n_docs, stats.avgdl).orderBy(*best).limit(k)

        found = scored(self._postings(terms, t0).filter(F.col("block").isin(chosen)))
        held = found.collect()  # k rows
        rest = bounds.filter(~F.col("block").isin(chosen))
        if len(held) == k:
            last = held[-1]
            rest = rest.filter((F.col("bound") > last.score + MARGIN)
                               | ((F.col("bound") >= last.score - MARGIN) & (F.col("min_doc") < last.doc_id)))
        more = rest.count()
        if read is not None:
            read += [len(chosen) + more, bounds.count() - len(chosen) - more]
        got = self.spark.createDataFrame(held, found.schema)
        if more:
            late = scored(self._postings(terms, t0).join(rest.select("block"), "block", "left_semi"))
            got = self.spark.createDataFrame(late.collect() + held, found.schema)
        return self._with_messages(got.orderBy(*best).limit(k))

    def _with_messages(self, found: DataFrame) -> DataFrame:
        """Joins the messages of a few rows: their blocks and ids reach the scan."""
        rows = found.collect()
        docs = self.documents.filter(F.col("block").isin([r.block for r in rows]) & F.col("doc_id").isin([r.doc_id for r in rows]))
        kept = self.spark.createDataFrame(rows, found.schema)
        return (kept.join(docs.select("doc_id", "message"), "doc_id").orderBy(F.desc("score"), "doc_id")
                .select("doc_id", "message", "time_sended", "explanation", "score"))

"""Topic search over payments: P3-P8 and the BM25 explained search.

Matching is a filter, never a score: time predicates come first so they
reach the parquet scan (and partition pruning on ``day`` for ingested
tables), then one ``arrays_overlap`` against a bounded literal set.
"""

from __future__ import annotations

import datetime as _dt
import json
import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.numbering import numbered

MODES = ("match", "term", "prefix", "match_phrase")
GRAINS = {"day", "month"}  # partition columns of the stored table
PHRASE_SEP = "\x1f"  # Java whitespace: never inside a token


def _lit_array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def topic_predicate(tokens: Column | str, topic: str, mode: str = "match",
                    synonyms: bool = False, emoticons: dict[str, str] | None = None,
                    synonym_rows: text.Synonyms | None = None, standard: bool = False) -> Column:
    """Boolean column, true when the token array matches the topic.

    ``match``: analysed topic, OR over its tokens; ``term``: the raw string
    must equal an indexed token; ``prefix``: an indexed token starts with the
    raw string; ``match_phrase``: analysed tokens contiguous in the message.
    With ``synonyms`` the index is taken as expanded (emoji -> words), which
    is evaluated by expanding the query side.  ``emoticons`` and
    ``synonym_rows`` replace the built-in dictionaries; with ``standard`` the
    topic is analysed like the four-field index (X2).
    """
    def analysed(t: str) -> list[str]:
        if standard:
            return [w for w in re.split(r"[^\w]+", t.lower()) if w]
        return text.analyze_text(t, emoticons)

    tok = F.col(tokens) if isinstance(tokens, str) else tokens
    if mode == "match":
        q = analysed(topic)
        m = text.match_set(q, synonyms, synonym_rows)
    elif mode == "term":
        m = text.match_set([topic], synonyms, synonym_rows)
    elif mode == "prefix":
        pred = F.exists(tok, lambda t: t.startswith(topic))
        if synonyms:
            extra = text.prefix_emoji(topic, synonym_rows)
            if extra:
                pred = pred | F.arrays_overlap(tok, _lit_array(extra))
        return F.coalesce(pred, F.lit(False))
    elif mode == "match_phrase":
        q = analysed(topic)
        if not q:
            return F.lit(False)
        if len(q) == 1:
            m = text.match_set(q, synonyms, synonym_rows)
        else:
            needle = PHRASE_SEP + PHRASE_SEP.join(q) + PHRASE_SEP
            hay = F.concat(F.lit(PHRASE_SEP), F.array_join(tok, PHRASE_SEP), F.lit(PHRASE_SEP))
            return F.coalesce(F.instr(hay, needle) > 0, F.lit(False))
    else:
        raise ValueError(f"unsupported query type {mode!r}; one of {MODES}")
    if not m:
        return F.lit(False)
    return F.coalesce(F.arrays_overlap(tok, _lit_array(m)), F.lit(False))


def _ts(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, (_dt.datetime, _dt.date)):
        return F.lit(value).cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")


def time_between(df: DataFrame, t0, t1, col: str = "time_sended") -> DataFrame:
    """Inclusive on both ends.  On a stored table partitioned by ``day``
    or ``month`` the derived predicate prunes partitions."""
    for grain in GRAINS & set(df.columns):
        df = df.filter(F.col(grain).between(*[F.to_date(F.date_trunc(grain, _ts(t))) for t in (t0, t1)]))
    return df.filter(F.col(col).between(_ts(t0), _ts(t1)))


def since(df: DataFrame, t0, col: str = "time_sended") -> DataFrame:
    """``col >= t0``."""
    for grain in GRAINS & set(df.columns):
        df = df.filter(F.col(grain) >= F.to_date(F.date_trunc(grain, _ts(t0))))
    return df.filter(F.col(col) >= _ts(t0))


def match_topic(payments: DataFrame, topic: str, t0=None, t1=None, mode: str = "match",
                synonyms: bool = False, message: str = "message",
                tokens: str | None = None, emoticons: dict[str, str] | None = None,
                synonym_rows: text.Synonyms | None = None, standard: bool = False) -> DataFrame:
    """P4+P6: payments whose message matches ``topic`` within ``[t0, t1]``.

    ``tokens`` names a precomputed token column (ingested tables carry one);
    otherwise the message is analysed on the fly, after the time filter.
    """
    df = payments
    if t0 is not None and t1 is not None:
        df = time_between(df, t0, t1)
    elif t0 is not None:
        df = since(df, t0)
    own = text.analyze_standard(message) if standard else text.analyze(message, emoticons)
    tok = F.col(tokens) if tokens else own
    return df.filter(topic_predicate(tok, topic, mode, synonyms, emoticons, synonym_rows, standard))


#: Token rows that one task sorts or groups, about: it then holds them in its memory.
TOKENS = 1 << 20


def token_tasks(docs: DataFrame, tokens: str = "tokens") -> int | None:
    """Tasks to deal the token rows of the documents to, if these need more
    than the shuffle partitions."""
    n = -(-(docs.agg(F.sum(F.size(tokens)).alias("n")).first().n or 0) // TOKENS)
    return n if n > int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def build_token_index(token_rows: DataFrame, path: str, partitions: int | None = None) -> None:
    """X3 stored: token rows in ranges of (token, document), sorted within each
    file, so a token lookup reads few row groups (parquet min/max skipping)."""
    # by range of (token, document): a frequent token is spread over several tasks and files
    order = ["token", *[c for c in token_rows.columns if c not in ("token", "pos", "synonym")]]
    df = token_rows.repartitionByRange(partitions, *order) if partitions else token_rows.repartitionByRange(*order)
    df.sortWithinPartitions("token").write.mode("overwrite").option("compression", "zstd").parquet(path)


def docs_with_tokens(index: DataFrame, tokens: list[str], id_cols: list[str]) -> DataFrame:
    """P4 at scale: ids of documents holding any of ``tokens`` (a bounded
    literal set, pushed to the scan as an IN filter)."""
    return index.filter(F.col("token").isin(*tokens)).select(*id_cols).distinct()


def index_stats(token_rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per token ``df`` (documents holding it) and ``tf`` (occurrences).

    One aggregate keyed by token; ``count_distinct`` is planned as a
    two-level aggregate (dedup on ``(token, doc)`` first), so a very common
    token is pre-reduced per task instead of landing on one reducer whole."""
    return token_rows.groupBy("token").agg(F.count_distinct(id_col).alias("df"),
                                           F.count("*").alias("tf"))


def field_stats(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    """``(n_docs, avgdl)`` over documents with at least one term."""
    return docs.filter(F.size(tokens) > 0).agg(
        F.count("*").alias("n_docs"), F.avg(F.size(tokens)).alias("avgdl"))


def pages(matched: DataFrame, size: int = 9999):
    """S5 for paged consumers: yields lists of at most ``size`` rows, pulled
    partition by partition (``toLocalIterator``), never the whole result."""
    page = []
    for row in matched.toLocalIterator(prefetchPartitions=True):
        page.append(row)
        if len(page) == size:
            yield page
            page = []
    if page:
        yield page


def page(matched: DataFrame, size: int = 9999, after: str | None = None, time: str = "time_sended",
         doc_id: str = "doc_id") -> tuple[list, str | None]:
    """One page of a result in the order of (time, document), and the
    cursor of the next one (None after the last page).

    A page is a job of its own that keeps nothing between calls: the cursor
    says where the last page ended, as text, so reading can go on later or in
    another session.  On a stored table partitioned by ``day`` the days before it
    are pruned.  Rows without a time come first.  ``doc_id`` must be unique."""
    df = matched
    if after is not None:
        t, d = json.loads(after)
        last = F.lit(d)
        if t is None:
            df = df.filter(F.col(time).isNotNull() | (F.col(doc_id) > last))
        else:
            at = F.lit(t).cast("timestamp_ntz")
            for grain in GRAINS & set(df.columns):
                df = df.filter(F.col(grain) >= F.to_date(F.date_trunc(grain, at)))
            df = df.filter((F.col(time) > at) | ((F.col(time) == at) & (F.col(doc_id) > last)))
    # one row more than the page shows whether there is another
    rows = df.orderBy(F.asc_nulls_first(time), doc_id).limit(size + 1).collect()
    if len(rows) <= size:
        return rows, None
    last = rows[size - 1]
    return rows[:size], json.dumps([None if last[time] is None else last[time].isoformat(), last[doc_id]])


def all_pages(matched: DataFrame, size: int = 9999, time: str = "time_sended", doc_id: str = "doc_id") -> DataFrame:
    """S5 for a whole result: every row with the number of its ``page``, as
    ``page`` gives them one by one.  The pages are counted where the rows lie:
    none of them goes through the driver."""
    rows = numbered(matched, [time, doc_id], "number")
    return rows.select(F.expr(f"number div {int(size)}").alias("page"), *matched.columns)


def sample_messages(matched: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` hits in a fixed order (top-k, not a full sort)."""
    order = ["time_sended", "actor_id", "target_id", "message"]
    return (matched.orderBy(*order).limit(n)
            .select("actor_name", "target_name", "message", "time_sended", "actor_id", "target_id"))


# ---------------------------------------------------------------------------
# BM25 relevance with explanation

K1 = 1.2
B = 0.75


def _member_of(values: list[str]):
    arr = _lit_array(values)
    return lambda x: F.array_contains(arr, x)


def explained_search(docs: DataFrame, topic: str, t0, k: int = 10, doc_id: str = "doc_id",
                     message: str = "message", synonyms: bool = True, tokens: str | None = None) -> DataFrame:
    """Top-``k`` documents for ``match(topic) AND time >= t0`` with a
    per-term explanation.

    Statistics are global over ``docs`` (N, df, avgdl), computed in one
    aggregate pass; a document's term frequency counts base tokens equal to
    the term plus emoji whose synonyms contain it (index-time expansion).
    The ``range`` clause is a ``must`` clause and adds a constant 1.0.
    ``tokens`` names a stored token column, which is then read instead of
    analysing the messages again.
    """
    q = text.analyze_text(topic)
    terms = list(dict.fromkeys(text.expand(q) if synonyms else q))
    if not terms:
        return docs.sparkSession.createDataFrame([], _EXPLAIN_SCHEMA)
    syn = text.synonyms()
    carriers = {}
    for t in terms:
        s = {t}
        if synonyms:
            s.update(e for e, ws in syn.items() if t in ws)
        carriers[t] = sorted(s)

    if tokens:
        base = docs.select(doc_id, message, "time_sended", F.col(tokens).alias("tokens"),
                           *sorted(GRAINS & set(docs.columns)))
    else:
        base = text.with_tokens(docs.select(doc_id, message, "time_sended"), message)
    base = base.withColumn("dl", F.size("tokens"))
    tfs = [F.size(F.filter("tokens", _member_of(c))).alias(f"tf{i}")
           for i, c in enumerate(carriers.values())]
    base = base.select("*", *tfs)

    stats = base.filter(F.col("dl") > 0).agg(
        F.count("*").alias("n_docs"), F.avg("dl").alias("avgdl"),
        *[F.sum(F.when(F.col(f"tf{i}") > 0, 1).otherwise(0)).alias(f"df{i}")
          for i in range(len(terms))])

    hit = F.lit(False)
    for i in range(len(terms)):
        hit = hit | (F.col(f"tf{i}") > 0)
    cand = since(base, t0).filter(hit)
    joined = cand.crossJoin(F.broadcast(stats))  # one-row statistics

    parts = []
    for i, t in enumerate(terms):
        tf, df_, n = F.col(f"tf{i}"), F.col(f"df{i}"), F.col("n_docs")
        idf = F.log(F.lit(1.0) + (n - df_ + F.lit(0.5)) / (df_ + F.lit(0.5)))
        norm = tf * F.lit(K1 + 1) / (tf + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * F.col("dl") / F.col("avgdl")))
        parts.append(F.when(tf > 0, F.struct(
            F.lit(t).alias("term"), tf.cast("long").alias("tf"), df_.cast("long").alias("df"),
            n.cast("long").alias("n_docs"), F.col("dl").cast("long").alias("dl"),
            F.col("avgdl").alias("avgdl"), idf.alias("idf"), norm.alias("tf_norm"),
            (idf * norm).alias("score"))))
    expl = F.filter(F.array(*parts), lambda s: s.isNotNull())
    scored = joined.select(
        F.col(doc_id).alias("doc_id"), F.col(message).alias("message"), "time_sended",
        expl.alias("explanation"))
    scored = scored.withColumn(
        "score", F.aggregate("explanation", F.lit(0.0), lambda acc, s: acc + s["score"]) + F.lit(1.0))
    return scored.orderBy(F.desc("score"), F.asc("doc_id")).limit(k)


_EXPLAIN_SCHEMA = (
    "doc_id string, message string, time_sended timestamp_ntz, "
    "explanation array<struct<term:string,tf:bigint,df:bigint,n_docs:bigint,dl:bigint,"
    "avgdl:double,idf:double,tf_norm:double,score:double>>, score double")


def explanation_json(result: DataFrame) -> DataFrame:
    """R2: one JSON document per hit, keys sorted at every level."""
    fields = sorted(result.schema["explanation"].dataType.elementType.fieldNames())
    terms = F.transform("explanation", lambda e: F.struct(*[e[f].alias(f) for f in fields]))
    return result.select("doc_id", "score", F.to_json(F.struct(
        terms.alias("_explanation"), F.col("doc_id").alias("_id"),
        F.col("score").alias("_score"),
        F.struct("message", "time_sended").alias("_source"))).alias("json"))


def idf(n: int, df: int) -> float:
    """Python twin of the BM25 idf, for tests."""
    return math.log(1 + (n - df + 0.5) / (df + 0.5))

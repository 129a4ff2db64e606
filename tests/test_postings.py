import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from topicgraph.functions import text
from topicgraph.operators import postings
from topicgraph.operators import search as S
from topicgraph.session import scratch_path

WORDS = ["hot", "gear", "tea", "Coffee", "☕", "❤️", "hot,", "x", "y", "z", "hotel", "ho", "é"]


def corpus(spark, n=400, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        m = " ".join(rnd.choice(WORDS[:rnd.randint(1, len(WORDS))]) for _ in range(rnd.choice([0, 1, 2, 3, 5, 12])))
        rows.append((f"d{i:03d}", rnd.choice([m, m, m, None]) if i % 17 == 0 else m,
                     dt.datetime(2017, 1, 1) + dt.timedelta(days=rnd.randint(0, 60)), "clash"))
    return spark.createDataFrame(rows, "doc_id string, message string, time_sended timestamp_ntz, tokens_of string")


@pytest.fixture(scope="module")
def stored(spark):
    docs = corpus(spark).cache()
    return docs, postings.build(docs, scratch_path(spark, "index"), block=16)


def rows_of(df):
    return [(r.doc_id, r.message, r.time_sended, [tuple(e)[:6] for e in r.explanation], round(r.score, 9)) for r in df.collect()]


@pytest.mark.parametrize("topic,first,t0,k", [
    ("hot", 1, "2016-01-01", 10), ("hot", 100, "2017-02-10", 1000), ("tea gear", 3, "2017-02-10", 7),
    ("☕", 1, "2017-02-10", 10), ("hot hot x", 1, "2016-01-01", 10), ("coffee é z", 2, "2017-02-10", 1000),
    ("unknown", 1, "2016-01-01", 10), ("unknown hot", 1, "2018-01-01", 5), ("", 1, "2016-01-01", 10)])
def test_top_equals_the_full_search(stored, topic, first, t0, k):
    docs, index = stored
    assert rows_of(index.top(topic, t0, k, first)) == rows_of(S.explained_search(docs, topic, t0, k))


def test_blocks_are_skipped(spark):
    # one length, so all scores tie: the smallest ids decide, and other blocks cannot hold them
    docs = spark.range(3000).select(F.format_string("d%05d", "id").alias("doc_id"), F.lit("hot tea").alias("message"),
                                    F.lit(dt.datetime(2017, 1, 1)).cast("timestamp_ntz").alias("time_sended"))
    index = postings.build(docs, scratch_path(spark, "index"), block=100)
    read: list = []
    top = index.top("hot", "2016-01-01", 10, first=2, read=read)
    assert [r.doc_id for r in top.collect()] == [f"d{i:05d}" for i in range(10)]
    assert read == [2, 28]
    # rare words are in few blocks: the others are not bounded at all
    read.clear()
    rare = docs.withColumn("message", F.when(F.col("doc_id") == "d01234", "gear hot").otherwise(F.col("message")))
    index = postings.build(rare, scratch_path(spark, "index"), block=100)
    assert [r.doc_id for r in index.top("gear tea", "2016-01-01", 1, first=1, read=read).collect()] == ["d01234"]
    assert read[0] < 3


@pytest.mark.parametrize("mode,topic", [
    ("match", "hot"), ("match", "☕"), ("match", "gear é"), ("match", ""), ("term", "hot"), ("term", "Hot"),
    ("prefix", "ho"), ("prefix", "cof"), ("prefix", "☕"), ("prefix", ""), ("prefix", "q"), ("match_phrase", "hot gear"),
    ("match_phrase", "hot hot"), ("match_phrase", "tea"), ("match_phrase", "x y x"), ("match_phrase", "hot ☕"), ("match_phrase", "")])
def test_modes_equal_the_scan(stored, mode, topic):
    docs, index = stored
    find = {"match": index.match, "term": index.term, "prefix": index.prefix, "match_phrase": index.phrase}[mode]
    t0, t1 = (None, None) if len(topic) % 2 else ("2017-01-20", "2017-02-10")
    want = S.match_topic(docs, topic, t0, t1, mode=mode, synonyms=mode != "match_phrase")
    got = find(topic, t0, t1).collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in want.collect())
    assert all(r.time_sended is not None for r in got)


def test_base_tokens_only(spark, stored):
    docs, _ = stored
    index = postings.build(docs, scratch_path(spark, "index"), synonyms=False)
    want = S.match_topic(docs, "beverage", mode="match", synonyms=False)
    assert index.match("beverage").count() == want.count()
    assert rows_of(index.top("☕ hot", "2016-01-01")) == rows_of(S.explained_search(docs, "☕ hot", "2016-01-01", synonyms=False))


def test_terms_and_stats(stored):
    docs, index = stored
    toks = text.token_table(text.with_tokens(docs), ["doc_id"])
    want = {r.token: (r.df, r.tf) for r in S.index_stats(toks).collect()}
    assert {r.token: (r.df, r.tf) for r in index.terms.collect()} == want
    assert index.stats.first() == S.field_stats(text.with_tokens(docs)).first()


def test_plans_read_the_index_only(stored):
    _, index = stored

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    for df in (index.phrase("hot gear"), index.match("hot"), index.term("hot")):
        p = plan(df)
        assert "token" in p.split("PushedFilters")[1].split("]")[0]
        assert "message" not in p and "documents" not in p
    p = plan(index.prefix("ho"))
    assert "GreaterThanOrEqual(token,ho)" in p and "LessThan(token,hp)" in p


def test_next_string():
    assert postings._after("ho") == "hp" and postings._after("\U0010ffff") is None
    assert postings._after("a\U0010ffff") == "b" and postings._after("퟿") == ""


def test_empty(spark):
    docs = corpus(spark).limit(0)
    index = postings.build(docs, scratch_path(spark, "index"))
    assert index.top("hot").count() == 0 and index.match("hot").count() == 0 and index.phrase("hot tea").count() == 0

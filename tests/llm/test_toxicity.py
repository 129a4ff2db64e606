import math
import random

from pyspark.sql import functions as F

from topicgraph.llm import toxicity as X

SF = "/root/testdata/sf0.1"


def test_index_is_exact():
    rnd = random.Random(0)
    rows = [(str(i), rnd.randrange(2), {t: rnd.randrange(1, 4) for t in rnd.sample(range(30), rnd.randrange(0, 6))})
            for i in range(400)]
    m = X.Model([f"t{i}" for i in range(30)], [1 + rnd.random() for _ in range(30)], rows, 0.3)
    for _ in range(50):
        q = m.unit({t: rnd.randrange(1, 3) for t in rnd.sample(range(30), rnd.randrange(1, 6))})
        every = [(sum(x * v.get(t, 0) for t, x in q.items()), e) for e, v in enumerate(m.vectors)]
        want = sorted((s for s in every if s[0] > 0), key=lambda s: (-round(s[0], 9), s[1]))[:X.K]
        got = m.index.nearest(q, X.K)
        assert [e for _, e in got] == [e for _, e in want]
        assert all(math.isclose(a, b, rel_tol=1e-9) for (a, _), (b, _) in zip(got, want))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = X.held_out(F.col("doc_id"))
    model = X.fit(docs, labels, learn=~out)
    rows = (X.score(docs.join(labels, "doc_id").filter(out), model)
            .select("toxic", F.col("toxicity.score").alias("s")).collect())
    toxic, clean = [r.s for r in rows if r.toxic], [r.s for r in rows if not r.toxic]
    assert len(toxic) > 30
    assert sum(s >= 0.5 for s in toxic) / len(toxic) > 0.9
    assert sum(s >= 0.5 for s in clean) / len(clean) < 0.01
    assert all(0 <= r.s <= 1 for r in rows)


def test_edge_rows(spark):
    rows = [(i, f"nice{i % 7} day to walk" if i % 2 else f"idiot scum day {i % 7}") for i in range(40)]
    rows += [(100, None), (101, ""), (102, "zzz"), (103, "idiot " * 100_000), (None, "idiot scum"), (0, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(i, (i + 1) % 2) for i in range(40)] + [(0, 0), (None, 1), (5, None)],
                                   "doc_id bigint, toxic int")
    model = X.fit(docs, labels)
    got = [(r.doc_id, r.toxicity.score) for r in X.score(docs, model).collect()]
    assert len(got) == len(rows) and all(0 <= s <= 1 for _, s in got)
    s = dict(got)
    assert s[103] > 0.5 and s[None] > 0.5 and s[1] < 0.5 and s[100] == s[101] == s[102]
    kept = X.reject(docs, model)
    assert kept.columns == docs.columns
    assert X.reject(docs.limit(0), model).collect() == []
    empty = X.fit(docs, labels.limit(0))
    assert {r.toxicity.score for r in X.score(docs, empty).collect()} == {0.0}

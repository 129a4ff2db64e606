import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from topicgraph.llm import decontamination as D
from topicgraph.llm import toxicity
from topicgraph.llm.queries import MIX_WEIGHTS

from .test_line_templates import brute as brute_lines
from .test_mixing import brute as brute_mix
from .test_simhash import brute_components, brute_fp

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF).cache()
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_registered(spark):
    assert [n for n in entry.queries() if n.startswith("op")] and "pipeline" in entry.queries()
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_columns(stages):
    for name, (_, after) in stages.items():
        assert after.columns == COLUMNS + (["n_tokens", "epoch"] if name == "mixing" else [])


def test_toxic_documents_go(spark, stages):
    before, after = stages["toxicity"]
    model = toxicity.fit(before, spark.read.parquet(f"{SF}/labels.parquet"), learn=~toxicity.held_out(F.col("doc_id")))
    scorer = toxicity.Scorer(model)
    assert ids(after) == {r.doc_id for r in before.collect() if scorer(r.text)[0] < 0.5}
    assert 0 < before.count() - after.count() < 0.2 * before.count()


def test_lines(stages):
    before, after = stages["line_dedup"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    want = {d: t for d, t in brute_lines(rows) if t.strip() or not dict(rows)[d].strip()}
    got = {r.doc_id: r.text for r in after.collect()}
    assert got == want
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_near_copies(stages):
    before, after = stages["simhash_near_dedup"]
    comps = brute_components([(r.doc_id, brute_fp(r.text)) for r in before.collect()])
    assert ids(after) == {c for _, _, c in comps} and after.count() == len({c for _, _, c in comps})


def test_benchmark(spark, stages):
    before, after = stages["decontamination"]
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert D.find(before, items).filter("size(spans) > 0").count() > 0
    assert D.find(after, items).filter("size(spans) > 0").count() == 0
    clean = {r.doc_id for r in D.find(before, items).filter("size(spans) = 0").collect()}
    texts = {r.doc_id: r.text for r in before.collect()}
    assert {r.doc_id: r.text for r in after.collect() if r.doc_id in clean} == {d: texts[d] for d in clean}


def test_mixture(stages):
    before, after = stages["mixing"]
    rows = [(r.doc_id, r.text, f"domain{int(r.source[3:]) % 4}", r.lang, r.source) for r in before.collect()]
    total = sum(len(t.split()) for _, t, *_ in rows)
    assert sorted(((r.doc_id, r.text, r.epoch) for r in after.collect()), key=repr) == brute_mix(rows, MIX_WEIGHTS, total // 2, 4)


def test_run_on_odd_rows(spark, tmp_dir):
    rows = [(1, None, None, None, None), (2, "", "en", "src1", 0), (2, "", "en", "src1", 0), (None, "no id here at all", "en", "src2", 9),
            (3, "a b c d e f g h i j k", "en", "odd", 21), (4, "long " * 100_000, "fr", "src3", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = docs.withColumn("domain", F.lit("x")).withColumn("epoch", F.lit(1)).withColumn("found", F.lit(2))
    for name, n in (("full", docs), ("empty", docs.limit(0))):
        sf = f"{tmp_dir}/{name}"
        n.write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame([(3, 1, 0), (4, 1, 1), (5, 1, 0), (1, 0, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
        spark.createDataFrame([(1, "b c d")], "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")
        out = corpus_pipeline.run(spark, sf)
        assert out.columns == docs.columns + ["n_tokens", "epoch_"]
        assert (out.count() > 0) == (name == "full")
        assert {r.text for r in out.collect() if r.doc_id == 3} <= {"a  e f g h i j k"}

"""One key with 70 % of the rows: the joins that meet it are split."""

import pytest
from pyspark.sql import functions as F

from topicgraph.llm import block_naming, mixing, simhash, warc
from topicgraph.llm.common import written

N = 60_000
CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "12"}


@pytest.fixture()
def no_broadcast(spark):
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    rows = df.collect()
    return len(rows), df._jdf.queryExecution().executedPlan().toString()


def hot(spark, name):
    return spark.range(0, N, 1, 12).select("id", F.when(F.col("id") % 10 < 7, F.lit(0)).otherwise(F.col("id") % 4000).alias(name))


def test_payload_of_many_pages(spark, no_broadcast):
    rows = hot(spark, "k").select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.encode(F.col("k").cast("string"), "utf-8").alias("payload"))
    rows = written(rows.withColumn("key", F.sha2("payload", 256)), "rows")
    groups = written(rows.groupBy("key").agg(F.max("page_id").alias("first")), "groups")
    n, plan = final_plan(warc._referred(rows, groups))
    assert n == N and "skew=true" in plan


def test_group_of_many_documents(spark, no_broadcast):
    ids = hot(spark, "name").select(F.col("id").alias("row"), F.col("id").alias("doc_id"), F.lit("x").alias("text_sha256"), F.lit(1).alias("n_blocks"), "name")
    ids = written(ids, "ids")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    groups = written(ids.groupBy("n_blocks", "name").agg(first.alias("first"), F.count("*").alias("group_size")), "groups")
    n, plan = final_plan(block_naming._told(ids, groups))
    assert n == N and "skew=true" in plan


def test_component_of_many_fingerprints(spark, no_broadcast):
    named = written(hot(spark, "component").select(F.col("id").alias("fp"), "component", F.col("id").alias("first")), "named")
    least = written(named.groupBy("component").agg(F.min("first").alias("component_id")), "least")
    n, plan = final_plan(simhash._told(named, least))
    assert n == N and "skew=true" in plan


def test_names_do_not_depend_on_partitions(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("t"), F.col("id") % 40), 30).alias("text"))
    seen = []
    for n in ("3", "11"):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", n)
        ids = block_naming.identities(docs.repartition(int(n)), size=16).select("doc_id", "n_blocks", "name")
        seen.append(sorted(map(tuple, ids.collect())))
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert seen[0] == seen[1] and len({r[1:] for r in seen[0]}) == 40


def test_columns_of_any_name(spark):
    rows = [(i, "a b c " * (i % 5), "d", "l", f"s{i % 2}", -7, -8, -9, -10, -11) for i in range(40)]
    names = ["doc_id", "text", "domain", "lang", "source", "_n", "_whole", "_leaf0", "_cut", "n_tokens"]
    docs = spark.createDataFrame(rows, names)
    out = mixing.mix(docs, share=0.9)
    assert out.columns == [*names, "n_tokens_", "epoch"]
    got = out.collect()
    assert got and all(tuple(r)[5:10] == (-7, -8, -9, -10, -11) for r in got)
    plain = mixing.mix(docs.select(*names[:5]), share=0.9)
    assert sorted((r.doc_id, r.epoch) for r in got) == sorted((r.doc_id, r.epoch) for r in plain.collect())

"""One key with 70 % of the rows: the joins that meet it are split."""

import pytest
from pyspark.sql import functions as F

from topicgraph.operators import components as C
from topicgraph.operators import topic_graph as G
from topicgraph.operators.multigraph import MultiGraph

N = 120_000
CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "12"}


@pytest.fixture(scope="module")
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    ids = spark.range(0, N, 1, 16)
    source = F.when(F.col("id") % 10 < 7, F.lit("hub")).otherwise(F.concat(F.lit("n"), F.col("id") % 5000))
    edges = ids.select(F.concat(F.lit("e"), "id").alias("id"), source.alias("source"),
                       F.concat(F.lit("n"), (F.col("id") * 7) % 5000).alias("target"))
    nodes = spark.range(5000).select(F.concat(F.lit("n"), "id").alias("id")).unionByName(
        spark.createDataFrame([("hub",)], "id string"))
    yield MultiGraph(nodes.checkpoint(), edges.checkpoint())
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_large_star(skewed):
    e = skewed.edges.select(F.col("source").alias("b"), F.col("target").alias("a")).checkpoint()
    rows, plan = final_plan(C._large_star(e))
    assert "skew=true" in plan and rows


def test_validate(skewed):
    rows, plan = final_plan(skewed.validate())
    assert "skew=true" in plan and rows == []


def test_drop_nodes_and_induced(skewed, spark):
    some = skewed.nodes.filter("id LIKE 'n1%'")
    rows, plan = final_plan(skewed.drop_nodes(some, check=False).edges)
    assert "skew=true" in plan
    assert len(rows) == skewed.edges.filter("NOT (source LIKE 'n1%' OR target LIKE 'n1%')").count()
    rows, plan = final_plan(G.induced_subgraph(skewed.edges, skewed.nodes))
    assert "skew=true" in plan and len(rows) == N


def test_neighborhood(skewed, spark):
    centers = spark.createDataFrame([("n1",), ("n2",)], "id string")
    rows, plan = final_plan(skewed.neighborhood(centers).edges.select("center_id", "id"))
    assert "skew=true" in plan and rows

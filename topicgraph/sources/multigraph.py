"""Directed multigraphs derived from the tables.

``payment_multigraph``: every customer is a node (label = name; position and
size by fixed arithmetic on the keys), every payment an edge (id = the line
keys; size = line number).  Parallel edges, reversed pairs, self-loops and,
for a topic-filtered edge set, isolated nodes all occur naturally.
``supply_graph``: suppliers as nodes and one edge per order line from the
supplier to its part (parts are not nodes, part ids repeat) — merged with
the payment graph it exercises every validation rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.multigraph import MultiGraph
from .payments import payment_id, payment_lines
from .tables import table

# fixed values: node layout arithmetic.  Customers are dealt over the places of a
# square grid whose side grows with the root of their number: the density is constant
STEP, SPREAD = 104729, 26

NODE_SQL = (f"SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS label, "
            f"CAST((c_custkey * {STEP}) % (side * side) % side AS DOUBLE) / 10.0 AS x, "
            f"CAST((c_custkey * {STEP}) % (side * side) // side AS DOUBLE) / 10.0 AS y, "
            f"1.0 + CAST(c_nationkey % 5 AS DOUBLE) AS size FROM customer, "
            f"(SELECT CAST(ceil({SPREAD} * sqrt(count(*))) AS BIGINT) AS side FROM customer)")


def customer_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    side = c.agg(F.ceil(F.lit(SPREAD) * F.sqrt(F.count("*"))).alias("side"))
    c = c.crossJoin(F.broadcast(side))  # one row
    place = (F.col("c_custkey") * STEP) % (F.col("side") * F.col("side"))
    return c.select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("label"),
        ((place % F.col("side")).cast("double") / 10.0).alias("x"),
        (F.floor(place / F.col("side")).cast("double") / 10.0).alias("y"),
        (F.lit(1.0) + (F.col("c_nationkey") % 5).cast("double")).alias("size"))


def payment_edges(lines: DataFrame) -> DataFrame:
    return lines.select(payment_id().alias("id"), F.col("actor_id").alias("source"),
                        F.col("target_id").alias("target"),
                        F.col("l_linenumber").cast("double").alias("size"))


def payment_multigraph(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> MultiGraph:
    lines = lines if lines is not None else payment_lines(spark, sf_dir)
    return MultiGraph(customer_nodes(spark, sf_dir), payment_edges(lines))


def supply_graph(spark: SparkSession, sf_dir: str) -> MultiGraph:
    s = table(spark, sf_dir, "supplier")
    li = table(spark, sf_dir, "lineitem")
    nodes = s.select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("label"))
    edges = li.select(F.concat_ws("-", "l_partkey", "l_suppkey").alias("id"),
                      F.col("l_suppkey").cast("string").alias("source"),
                      F.concat(F.lit("part"), F.col("l_partkey").cast("string")).alias("target"))
    return MultiGraph(nodes, edges)

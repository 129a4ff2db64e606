"""The undirected, simple, weighted topic graph.

Edges are keyed ``(least, greatest)`` so a pair paid in both directions is
one edge; its weight counts payments.  Degree counts distinct partners and a
self-loop adds two.  Every aggregate here is a hash aggregate with map-side
partial combine, so a hub that holds a third of the payments is pre-reduced
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HIST_CAP = 20  # bins above this collapse into "20+"


def build_edges(payments: DataFrame) -> DataFrame:
    """A1: ``(source, target, weight)`` with ``source <= target``."""
    a, t = F.col("actor_id"), F.col("target_id")
    return (payments.groupBy(F.least(a, t).alias("source"), F.greatest(a, t).alias("target"))
            .agg(F.count("*").alias("weight")))


def build_nodes(payments: DataFrame) -> DataFrame:
    """One node per id; the name is the one on the earliest payment
    (ties: smallest name)."""
    sides = payments.select(F.col("actor_id").alias("id"), F.col("actor_name").alias("name"),
                            "time_sended").unionByName(
        payments.select(F.col("target_id").alias("id"), F.col("target_name").alias("name"),
                        "time_sended"))
    return (sides.groupBy("id")
            .agg(F.min_by("name", F.struct("time_sended", "name")).alias("name")))


def degrees(edges: DataFrame) -> DataFrame:
    """A3: ``(id, degree)`` = distinct partners; a self-loop counts two."""
    return (edges.select(F.explode(F.array("source", "target")).alias("id"))
            .groupBy("id").agg(F.count("*").alias("degree")))


def degrees_and_names(payments: DataFrame) -> DataFrame:
    """A2+A3 in one pass over the payments: ``(id, name, degree)``.

    Each payment gives two sides ``(id, partner)``; one aggregate on
    ``(id, partner)`` makes partners distinct (map-side combined, so a hub's
    repeated partners are reduced before the shuffle), a second on ``id``
    counts them (a self-loop twice, as in A3) and keeps the name of the
    earliest payment."""
    first = F.struct("time_sended", "name")
    sides = payments.select(F.explode(F.array(
        F.struct(F.col("actor_id").alias("id"), F.col("target_id").alias("partner"),
                 F.col("actor_name").alias("name"), "time_sended"),
        F.struct(F.col("target_id").alias("id"), F.col("actor_id").alias("partner"),
                 F.col("target_name").alias("name"), "time_sended"))).alias("s")).select("s.*")
    pairs = sides.groupBy("id", "partner").agg(F.min(first).alias("first"))
    return pairs.groupBy("id").agg(
        F.min("first").getField("name").alias("name"),
        (F.count("*") + F.sum(F.when(F.col("partner") == F.col("id"), 1).otherwise(0))).alias("degree"))


def top_users_from_payments(payments: DataFrame, k: int = 10) -> DataFrame:
    """T1 with J1 folded in: one scan of the matched payments."""
    d = degrees_and_names(payments)
    return (d.orderBy(F.desc("degree"), F.asc("id")).limit(k)
            .select(F.col("id").alias("user_id"), F.col("name").alias("user_name"),
                    F.col("degree").alias("degrees")))


def graph_summary(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row ``(nodes, edges, density)``; density 2m/(n(n-1)),
    0 when n <= 1."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    rows = nodes.select(one.alias("nodes"), none.alias("edges")).unionAll(edges.select(none, one))
    both = rows.agg(*[F.coalesce(F.sum(c), none).alias(c) for c in ("nodes", "edges")])
    dens = F.when(F.col("nodes") <= 1, F.lit(0.0)).otherwise(
        F.lit(2.0) * F.col("edges") / (F.col("nodes") * (F.col("nodes") - 1)))
    return both.select("nodes", "edges", dens.alias("density"))


def top_users(deg: DataFrame, nodes: DataFrame, k: int = 10) -> DataFrame:
    """T1+J1: the ``k`` users with most partners, id ascending on ties."""
    top = deg.orderBy(F.desc("degree"), F.asc("id")).limit(k)  # TakeOrderedAndProject
    named = top.join(F.broadcast(nodes.join(top.select("id"), "id", "left_semi")), "id", "left")
    return named.select(F.col("id").alias("user_id"), F.col("name").alias("user_name"),
                        F.col("degree").alias("degrees"))


def histogram(values: DataFrame, col: str, start: int, cap: int = HIST_CAP) -> DataFrame:
    """Bar series ``(bin, pos, value)``.

    If the maximum exceeds ``cap``: bins ``start..cap-1`` then ``"cap+"``
    holding the raw count of values >= cap; otherwise bins ``start..max``.
    Empty ordinary bins become 0.01 (log-axis floor).  Counting is a
    distributed aggregate; only the <= ``cap`` bins meet the one-row maximum.
    """
    counts = values.groupBy(F.col(col).alias("v")).agg(F.count("*").alias("n"))
    mx = values.agg(F.max(col).alias("mx"))
    big = F.col("mx") > cap
    binned = (counts.crossJoin(F.broadcast(mx))
              .select(F.when(big & (F.col("v") >= cap), F.lit(cap)).otherwise(F.col("v")).alias("pos"),
                      "n")
              .groupBy("pos").agg(F.sum("n").alias("n")))
    # least() skips NULLs: an empty input (NULL maximum) must give no bins
    last = F.when(F.col("mx").isNotNull(), F.least(F.col("mx"), F.lit(cap)))
    spine = mx.select("mx", F.explode(F.when(last >= start, F.sequence(F.lit(start), last))
                                      .otherwise(F.array().cast("array<bigint>"))).alias("pos"))
    spine = spine.withColumn("pos", F.col("pos").cast("long"))
    joined = spine.join(binned.withColumn("pos", F.col("pos").cast("long")), "pos", "left")
    tail = big & (F.col("pos") == cap)
    n = F.coalesce(F.col("n"), F.lit(0)).cast("double")
    return joined.select(
        F.when(tail, F.lit(f"{cap}+")).otherwise(F.col("pos").cast("string")).alias("bin"),
        F.col("pos").cast("int").alias("pos"),
        F.when(tail, n).otherwise(F.greatest(n, F.lit(0.01))).alias("value"))


def degree_histogram(deg: DataFrame) -> DataFrame:
    """Bins from 1."""
    return histogram(deg, "degree", 1)


def induced_subgraph(edges: DataFrame, chosen: DataFrame, id_col: str = "id") -> DataFrame:
    """Edges whose two endpoints are both in ``chosen``."""
    ids = chosen.select(F.col(id_col).alias("_id"))
    return (edges.join(ids, F.col("source") == F.col("_id"), "left_semi")
                 .join(ids, F.col("target") == F.col("_id"), "left_semi"))

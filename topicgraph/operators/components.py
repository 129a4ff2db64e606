"""Connected components and the community report.

Components use the alternating large-star / small-star contraction
(Kiveris et al., "Connected Components in MapReduce and Beyond", SoCC 2014):
O(log^2 n) rounds, each a few hash aggregates and joins on node id.  Stars
shrink a hub's fan-out round by round, aggregates combine map-side, and the
minima are written before they are joined back, so that AQE can split the
partition of a hub.  Every round's edge set is checkpointed to
the reliable checkpoint directory, so lineage stays one round deep and a lost
executor recomputes at most one round.  The only value returned to the
driver per round is a boolean (is the edge set a set of stars?).
(A round's edge set is usually far smaller than the input after the first
contraction, so the per-round checkpoint write is cheap.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .topic_graph import histogram


def _large_star(e: DataFrame) -> DataFrame:
    """Each node links every larger neighbour to the minimum of its closed
    neighbourhood."""
    both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    m = both.groupBy("u").agg(F.min("v").alias("mn"))
    # written first: a join of two plain inputs is one whose large partitions AQE splits,
    # a join with a fresh aggregate is not
    m = m.select("u", F.least(F.col("u"), F.col("mn")).alias("mu")).checkpoint()
    return (both.join(m, "u").filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("a"), F.col("mu").alias("b")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the minimum of
    them."""
    m = e.groupBy("a").agg(F.min("b").alias("mn")).checkpoint()
    moved = (e.join(m, "a").filter(F.col("b") != F.col("mn"))
             .select(F.col("b").alias("a"), F.col("mn").alias("b")))
    return moved.unionByName(m.select("a", F.col("mn").alias("b"))).distinct()


def _is_star_forest(e: DataFrame) -> bool:
    parents = e.groupBy("a").agg(F.count("*").alias("k"))
    multi = parents.filter(F.col("k") > 1).select("a")
    deep = e.select(F.col("b").alias("a")).join(parents.select("a"), "a", "left_semi")
    return multi.unionByName(deep).isEmpty()


def connected_components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 100,
                         id_col: str = "id") -> DataFrame:
    """G1: ``(id, component)``, component = smallest id in it (string order).

    ``nodes`` supplies every vertex (isolated and self-loop-only ones become
    singleton components); ``edges`` has ``source``/``target``.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    s, t = F.col("source"), F.col("target")
    e = (edges.filter(s != t)
         .select(F.greatest(s, t).alias("a"), F.least(s, t).alias("b")).distinct())
    e = e.checkpoint()
    for _ in range(max_rounds):
        e = _small_star(_large_star(e)).checkpoint()
        if _is_star_forest(e):
            break
    else:
        raise RuntimeError(f"components did not converge in {max_rounds} rounds")
    parent = e.select(F.col("a").alias(id_col), F.col("b").alias("component"))
    return (nodes.select(id_col).distinct().join(parent, id_col, "left")
            .select(id_col, F.coalesce("component", id_col).alias("component")))


def component_sizes(comp: DataFrame) -> DataFrame:
    """``(component, size)``."""
    return comp.groupBy("component").agg(F.count("*").alias("size"))


def component_histogram(sizes: DataFrame) -> DataFrame:
    """Bins from 2; empty when every component is a singleton."""
    return histogram(sizes, "size", 2)


def top_communities(sizes: DataFrame, k: int = 10) -> DataFrame:
    """T2+W1: the ``k`` largest components, ties by component id, with the
    ordinal ``group`` 0..k-1.  The window runs over <= k rows."""
    top = sizes.orderBy(F.desc("size"), F.asc("component")).limit(k)
    w = Window.orderBy(F.desc("size"), F.asc("component"))
    return top.withColumn("group", (F.row_number().over(w) - 1).cast("int"))


def community_nodes(comp: DataFrame, top: DataFrame, deg: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nodes of the top communities with ``group`` and ``size = degree``.

    ``top`` has at most k rows, so it is broadcast."""
    sel = comp.join(F.broadcast(top.select("component", "group")), "component")
    return (sel.join(deg, "id").join(nodes, "id")
            .select("id", "name", "group", F.col("degree").alias("size"), "component"))


def community_edges(edges: DataFrame, cnodes: DataFrame) -> DataFrame:
    """The subgraph induced by the community nodes.

    Edges never cross components, so one semi-join on ``source`` is the
    whole induced subgraph (J2 needs the second only for arbitrary sets)."""
    ids = cnodes.select(F.col("id").alias("source"))
    return edges.join(ids, "source", "left_semi").select("source", "target", "weight")

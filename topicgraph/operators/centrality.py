"""HITS hub and authority scores on a directed multigraph.

Each round reads only the previous round's values:
``auth(v) = 1 + sum(hub(u))`` over distinct in-neighbours ``u != v`` and
``hub(v) = 1 + sum(auth(w))`` over distinct out-neighbours ``w != v``; each
vector is then divided by its own sum.  Directed: authorities are nodes with
in-degree > 0 and hubs nodes with out-degree > 0 (self-loops count for
membership); a node outside a list scores 0 there, and isolated nodes drop
out.  Undirected: every node is in both lists and neighbours are taken in
both directions.  Stop when every relative change is below ``eps`` (or after
``max_iter`` rounds).

Per round: the distinct non-loop pairs meet the scores at either end and one
map-side combined aggregate sums them; the unnormalised values are
checkpointed (computed once); one aggregate
over the checkpoint returns the two sums and the extremes the convergence
test needs, as six driver scalars.  Cutting
lineage every round matters twice: the round reads the state three times,
so the plan would triple per round, and a lost executor recomputes at most
one round.  ``hits`` takes any edges; ``hits_stored`` reads a stored adjacency
whose pairs lie by endpoint, so that no round exchanges them.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, shuffles_deleted
from .adjacency import Adjacency


def hits(nodes: DataFrame, edges: DataFrame, undirected: bool = False, eps: float = 1e-4,
         max_iter: int = 100, return_rounds: bool = False):
    """``(id, authority, hub)`` for the members of either list.

    Raises if the change is not below ``eps`` after ``max_iter`` rounds; with
    ``eps`` 0 exactly ``max_iter`` rounds are run."""
    ensure_checkpoint_dir(edges.sparkSession)
    s, t = F.col("source"), F.col("target")
    pairs = edges.filter(s != t).select("source", "target")
    if undirected:
        pairs = pairs.unionByName(pairs.select(t.alias("source"), s.alias("target")))
    pairs = pairs.distinct().persist(StorageLevel.MEMORY_AND_DISK)

    ids = nodes.select("id").distinct()
    if undirected:
        members = ids.select("id", F.lit(True).alias("is_auth"), F.lit(True).alias("is_hub"))
    else:
        has_in = edges.select(F.col("target").alias("id")).distinct().withColumn("is_auth", F.lit(True))
        has_out = edges.select(F.col("source").alias("id")).distinct().withColumn("is_hub", F.lit(True))
        members = (ids.join(has_in, "id", "left").join(has_out, "id", "left")
                   .fillna(False, ["is_auth", "is_hub"])
                   .filter(F.col("is_auth") | F.col("is_hub")))

    def met(state: DataFrame, side: str, *cols: str) -> DataFrame:
        end = "source" if side == "out" else "target"
        return pairs.join(state.select(F.col("id").alias(end), *cols), end)

    try:
        return _settled(members, met, undirected, eps, max_iter, return_rounds)
    finally:
        pairs.unpersist()


def hits_stored(adjacency: Adjacency, path: str, undirected: bool = False, eps: float = 1e-4, max_iter: int = 100,
                return_rounds: bool = False):
    """``hits`` on a stored adjacency.  The distinct pairs are written once
    to ``path``, bucketed at both ends; a round moves scores and sums of the
    nodes, never the edges, and a hub's edges stay in several parts."""
    ensure_checkpoint_dir(adjacency.spark)
    links = adjacency.links(path, undirected=undirected)
    is_auth, is_hub = (F.lit(True), F.lit(True)) if undirected else (F.col("in_degree") > 0, F.col("out_degree") > 0)
    members = (adjacency.nodes.select("id", is_auth.alias("is_auth"), is_hub.alias("is_hub"))
               .filter(F.col("is_auth") | F.col("is_hub")))

    def met(state: DataFrame, side: str, *cols: str) -> DataFrame:
        return links.meet(state.select("id", *cols), side)

    with shuffles_deleted(adjacency.spark):  # each round is checkpointed
        return _settled(members, met, undirected, eps, max_iter, return_rounds)


def _sums(state: DataFrame, met, undirected: bool) -> DataFrame:
    """``(id, sh, sa)``: sums of the hub scores of in-neighbours and of the
    authorities of out-neighbours, in one aggregate."""
    if undirected:  # pairs both ways: one side gives both sums
        rows = met(state, "out", "hub", "authority").select(F.col("target").alias("id"), F.col("hub").alias("h"),
                                                            F.col("authority").alias("a"))
    else:
        none = F.lit(None).cast("double")
        rows = met(state, "out", "hub").select(F.col("target").alias("id"), F.col("hub").alias("h"), none.alias("a"))
        rows = rows.unionByName(met(state, "in", "authority").select(
            F.col("source").alias("id"), none.alias("h"), F.col("authority").alias("a")))
    return rows.groupBy("id").agg(F.sum("h").alias("sh"), F.sum("a").alias("sa"))


def _settled(members: DataFrame, met, undirected: bool, eps: float, max_iter: int, return_rounds: bool):
    # round 0: every node starts at 1/1 (isolated nodes only matter as a
    # neighbour, and they have none)
    state = members.checkpoint().select("id", "is_auth", "is_hub", F.lit(1.0).alias("authority"), F.lit(1.0).alias("hub"))
    rounds = 0
    for rounds in range(1, max_iter + 1):
        raw = (state.select("id", "is_auth", "is_hub", F.col("authority").alias("a0"), F.col("hub").alias("h0"))
               .join(_sums(state, met, undirected), "id", "left")
               .select("id", "is_auth", "is_hub", "a0", "h0",
                       F.when(F.col("is_auth"), F.lit(1.0) + F.coalesce("sh", F.lit(0.0)))
                        .otherwise(F.lit(0.0)).alias("ra"),
                       F.when(F.col("is_hub"), F.lit(1.0) + F.coalesce("sa", F.lit(0.0)))
                        .otherwise(F.lit(0.0)).alias("rh")))
        # the joins run once: raw is checkpointed and one aggregate over it
        # gives the two sums and the convergence test.  The relative change
        # |raw/S - prev| / prev = |q/S - 1| with q = raw/prev is convex in q,
        # so its maximum is reached at the smallest or largest q.
        raw = raw.checkpoint()
        qa = F.when(F.col("is_auth"), F.col("ra") / F.col("a0"))
        qh = F.when(F.col("is_hub"), F.col("rh") / F.col("h0"))
        agg = raw.agg(F.sum("ra").alias("sa"), F.sum("rh").alias("sh"),
                      F.min(qa).alias("qa0"), F.max(qa).alias("qa1"),
                      F.min(qh).alias("qh0"), F.max(qh).alias("qh1")).first()
        if agg is None or agg["sa"] is None:
            state = raw.select("id", "is_auth", "is_hub", F.lit(0.0).alias("authority"),
                               F.lit(0.0).alias("hub"))
            break
        state = raw.select("id", "is_auth", "is_hub", (F.col("ra") / F.lit(agg["sa"])).alias("authority"),
                           (F.col("rh") / F.lit(agg["sh"])).alias("hub"))
        ends = [(agg["qa0"], agg["sa"]), (agg["qa1"], agg["sa"]), (agg["qh0"], agg["sh"]), (agg["qh1"], agg["sh"])]
        change = max((abs(q / tot - 1.0) for q, tot in ends if q is not None), default=0.0)
        if change < eps:
            break
    else:
        if eps > 0:
            raise RuntimeError(f"no convergence to {eps} in {max_iter} rounds")
    out = state.select("id", "authority", "hub")
    return (out, rounds) if return_rounds else out

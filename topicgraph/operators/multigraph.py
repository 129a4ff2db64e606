"""The directed multigraph model: ``nodes(id, ...)``, ``edges(id, source,
target, ...)`` (A4, J4, J5, J7, J8, P9, P15, P16, U2, U3, G4).

Parallel edges and self-loops are allowed; node and edge ids are unique and
endpoints must exist (``validate`` reports violations as a table instead of
failing at the first).  Every operator takes and returns DataFrames; id
lists given by a caller are small driver values, id *tables* are joined.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def _ids_df(spark, ids) -> DataFrame:
    """A list of ids (driver value) or a DataFrame with an ``id`` column."""
    if isinstance(ids, DataFrame):
        return ids.select(F.col(ids.columns[0]).cast("string").alias("id"))
    if isinstance(ids, (str, int)):
        ids = [ids]
    return spark.createDataFrame([(str(i),) for i in ids], "id string")


_METHODS: dict = {}


@dataclass
class MultiGraph:
    nodes: DataFrame
    edges: DataFrame

    # E3 -----------------------------------------------------------------
    @classmethod
    def add_method(cls, name: str, fn) -> None:
        """Register ``fn(graph, *args)`` as ``graph.name(*args)``; names
        already taken (built-in or registered) are rejected."""
        if not isinstance(name, str) or not name:
            raise ValueError("a method name must be a non-empty string")
        if hasattr(cls, name) or name in _METHODS:
            raise ValueError(f"method {name!r} already exists")
        _METHODS[name] = fn
        setattr(cls, name, lambda self, *a, **k: fn(self, *a, **k))

    def pipe(self, fn, *args, **kwargs):
        """Apply a plain function over the graph (``DataFrame.transform`` for
        two frames)."""
        return fn(self, *args, **kwargs)

    @property
    def spark(self):
        return self.nodes.sparkSession

    # A4 -----------------------------------------------------------------
    def degrees(self, ins: DataFrame | None = None, outs: DataFrame | None = None) -> DataFrame:
        """``(id, in_degree, out_degree, degree)``: parallel edges count, a
        self-loop is one in and one out, isolated nodes get 0.  ``ins`` and
        ``outs`` are the edges ``n`` at each end, if they are counted already."""
        def counted(end: str) -> DataFrame:
            return self.edges.groupBy(F.col(end).alias("id")).agg(F.count("*").alias("n"))

        out_d = (counted("source") if outs is None else outs).withColumnRenamed("n", "out_degree")
        in_d = (counted("target") if ins is None else ins).withColumnRenamed("n", "in_degree")
        d = (self.nodes.select("id").join(in_d, "id", "left").join(out_d, "id", "left")
             .fillna(0, ["in_degree", "out_degree"]))
        return d.select("id", "in_degree", "out_degree",
                        (F.col("in_degree") + F.col("out_degree")).alias("degree"))

    # J7 -----------------------------------------------------------------
    def validate(self) -> DataFrame:
        """``(kind, id)`` for duplicate node ids, duplicate edge ids and edges
        whose source or target is not a node."""
        dn = (self.nodes.groupBy("id").count().filter("count > 1")
              .select(F.lit("duplicate_node").alias("kind"), "id"))
        de = (self.edges.groupBy("id").count().filter("count > 1")
              .select(F.lit("duplicate_edge").alias("kind"), "id"))
        ids = self.nodes.select(F.col("id").alias("nid"))  # an anti-join needs no distinct side
        ds = (self.edges.join(ids, F.col("source") == F.col("nid"), "left_anti")
              .select(F.lit("dangling_source").alias("kind"), "id"))
        dt = (self.edges.join(ids, F.col("target") == F.col("nid"), "left_anti")
              .select(F.lit("dangling_target").alias("kind"), "id"))
        return dn.unionByName(de).unionByName(ds).unionByName(dt)

    def check(self) -> "MultiGraph":
        """Raise on the first violation (the reference's behaviour)."""
        bad = self.validate().limit(1).collect()
        if bad:
            raise ValueError(f"invalid graph: {bad[0]['kind']} {bad[0]['id']!r}")
        return self

    # U2 U3 --------------------------------------------------------------
    def merge(self, other: "MultiGraph", check: bool = False) -> "MultiGraph":
        """Append another graph's nodes and edges; duplicates are violations."""
        g = MultiGraph(self.nodes.unionByName(other.nodes, allowMissingColumns=True),
                       self.edges.unionByName(other.edges, allowMissingColumns=True))
        return g.check() if check else g

    def add_nodes(self, nodes: DataFrame, check: bool = False) -> "MultiGraph":
        return self.merge(MultiGraph(nodes, self.edges.limit(0)), check)

    def add_edges(self, edges: DataFrame, check: bool = False) -> "MultiGraph":
        return self.merge(MultiGraph(self.nodes.limit(0), edges), check)

    # P9 -----------------------------------------------------------------
    def lookup_nodes(self, ids=None) -> DataFrame:
        """No argument: all nodes.  Otherwise the nodes in the given order with
        a ``pos`` column; unknown ids give a row of NULLs at their position."""
        return self._lookup(self.nodes, ids)

    def lookup_edges(self, ids=None) -> DataFrame:
        return self._lookup(self.edges, ids)

    def _lookup(self, df: DataFrame, ids) -> DataFrame:
        if ids is None:
            return df
        if isinstance(ids, (str, int)):
            ids = [ids]
        want = self.spark.createDataFrame([(i, str(x)) for i, x in enumerate(ids)], "pos int, want string")
        hit = want.join(df, F.col("want") == F.col("id"), "left")
        return hit.select("pos", *[F.col(c) for c in df.columns]).orderBy("pos")

    # P15 P16 ------------------------------------------------------------
    def drop_nodes(self, ids, check: bool = True) -> "MultiGraph":
        """Remove nodes and every incident edge; unknown ids are an error."""
        gone = _ids_df(self.spark, ids)
        if check:
            missing = gone.join(self.nodes.select("id"), "id", "left_anti").limit(1).collect()
            if missing:
                raise ValueError(f"unknown node {missing[0]['id']!r}")
        nodes = self.nodes.join(gone, "id", "left_anti")
        g = gone.select(F.col("id").alias("gid"))
        edges = (self.edges.join(g, F.col("source") == F.col("gid"), "left_anti")
                 .join(g, F.col("target") == F.col("gid"), "left_anti"))
        return MultiGraph(nodes, edges)

    def drop_edges(self, ids, check: bool = True) -> "MultiGraph":
        gone = _ids_df(self.spark, ids)
        if check:
            missing = gone.join(self.edges.select("id"), "id", "left_anti").limit(1).collect()
            if missing:
                raise ValueError(f"unknown edge {missing[0]['id']!r}")
        return MultiGraph(self.nodes, self.edges.join(gone, "id", "left_anti"))

    # J4 J5 --------------------------------------------------------------
    def adjacent_nodes(self, node_id: str) -> DataFrame:
        """Distinct neighbours in either direction (the node itself only
        through a self-loop)."""
        e = self.edges.filter((F.col("source") == node_id) | (F.col("target") == node_id))
        other = F.when(F.col("source") == node_id, F.col("target")).otherwise(F.col("source"))
        return self.nodes.join(e.select(other.alias("id")), "id", "left_semi")  # a semi-join needs no distinct side

    def adjacent_edges(self, node_id: str) -> DataFrame:
        return self.edges.filter((F.col("source") == node_id) | (F.col("target") == node_id))

    def adjacent_edges_of(self, ids: DataFrame) -> DataFrame:
        """Table form: edges touching any id of ``ids`` (one row per edge)."""
        g = ids.select(F.col(ids.columns[0]).alias("gid"))
        a = self.edges.join(g, F.col("source") == F.col("gid"), "left_semi")
        b = self.edges.join(g, F.col("target") == F.col("gid"), "left_semi")
        return a.unionByName(b).dropDuplicates(["id"])

    # J8 -----------------------------------------------------------------
    def edges_with_coords(self) -> DataFrame:
        """Edges with endpoint coordinates and Euclidean ``length``."""
        s = self.nodes.select(F.col("id").alias("source"), F.col("x").alias("x1"),
                              F.col("y").alias("y1"), F.col("size").alias("s1"))
        t = self.nodes.select(F.col("id").alias("target"), F.col("x").alias("x2"),
                              F.col("y").alias("y2"), F.col("size").alias("s2"))
        e = self.edges.join(t, "target").join(s, "source")  # payments lie by target
        rest = [c for c in self.edges.columns if c not in ("source", "target")]
        return e.select("target", "source", *rest, "x1", "y1", "s1", "x2", "y2", "s2",
                        euclid(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")).alias("length"))

    # G4 -----------------------------------------------------------------
    def neighborhood(self, centers) -> "MultiGraph":
        """Ego-nets: each centre, its neighbours (either direction), the edges
        centre-neighbour and neighbour-neighbour.  A self-loop on the centre
        is kept, one on a neighbour is dropped.  ``centers`` may be one id or
        a table of ids; the result carries ``center_id`` and ``center``."""
        if isinstance(centers, (str, int)):
            return self._one_neighborhood(str(centers))
        ensure_checkpoint_dir(self.spark)
        c = _ids_df(self.spark, centers).select(F.col("id").alias("center_id")).distinct()
        c = c.join(self.nodes.select(F.col("id").alias("center_id")), "center_id", "left_semi")
        e = self.edges
        # members: (center_id, id) — the centre and its neighbours
        out_n = e.join(c, F.col("source") == F.col("center_id")).select("center_id", F.col("target").alias("id"))
        in_n = e.join(c, F.col("target") == F.col("center_id")).select("center_id", F.col("source").alias("id"))
        members = (c.select("center_id", F.col("center_id").alias("id"))
                   .unionByName(out_n).unionByName(in_n).distinct()).checkpoint()
        # an edge belongs to the ego-net of c when both ends are members of c.
        # Probe memberships on the end that belongs to fewer ego-nets (ties by
        # id), then check the other end with a semi-join: the intermediate is
        # sum(min(k(u), k(v))) rows, so a hub in many ego-nets is never the
        # side that fans out (degree-ordered, as in triangle listing).
        k = members.groupBy("id").agg(F.count("*").alias("k")).checkpoint()  # plain sides: AQE splits a hub's partition
        ks = k.select(F.col("id").alias("source"), F.col("k").alias("ks"))
        kt = k.select(F.col("id").alias("target"), F.col("k").alias("kt"))
        oriented = e.join(ks, "source").join(kt, "target")
        src_probe = (F.col("ks") < F.col("kt")) | ((F.col("ks") == F.col("kt")) & (F.col("source") <= F.col("target")))
        oriented = oriented.select(*e.columns,
                                   F.when(src_probe, F.col("source")).otherwise(F.col("target")).alias("_probe"),
                                   F.when(src_probe, F.col("target")).otherwise(F.col("source")).alias("_other"))
        mp = members.select("center_id", F.col("id").alias("_probe"))
        mo = members.select("center_id", F.col("id").alias("_other"))
        sub = (oriented.join(mp, "_probe").join(mo, ["center_id", "_other"], "left_semi")
               .select("center_id", *e.columns))
        keep = (F.col("source") != F.col("target")) | (F.col("source") == F.col("center_id"))
        nodes = (members.join(self.nodes, "id")
                 .withColumn("center", F.col("id") == F.col("center_id")))
        return MultiGraph(nodes, sub.filter(keep))


    def _one_neighborhood(self, center: str) -> "MultiGraph":
        """The ego-net of one node: two filters and two semi-joins."""
        here = F.lit(center)
        touching = self.adjacent_edges(center)
        ids = (touching.select(F.col("source").alias("id")).unionByName(touching.select(F.col("target").alias("id")))
               .unionByName(self.nodes.filter(F.col("id") == here).select("id")))
        known = self.nodes.filter(F.col("id") == here).limit(1).select(here.alias("center_id"))  # no such node: empty
        nodes = (self.nodes.join(ids, "id", "left_semi").crossJoin(F.broadcast(known))
                 .withColumn("center", F.col("id") == here))
        inside = (self.edges.join(ids.select(F.col("id").alias("source")), "source", "left_semi")
                  .join(ids.select(F.col("id").alias("target")), "target", "left_semi"))
        keep = (F.col("source") != F.col("target")) | (F.col("source") == here)
        edges = inside.filter(keep).crossJoin(F.broadcast(known)).select("center_id", *self.edges.columns)
        return MultiGraph(nodes.select("center_id", "id", *[x for x in self.nodes.columns if x != "id"], "center"), edges)


def euclid(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt(F.pow(x1 - x2, 2) + F.pow(y1 - y2, 2))

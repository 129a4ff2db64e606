"""Layout-space operators.

All of them are column arithmetic over ``nodes(id, x, y, size)`` and
``edges(source, target, size)``; global quantities (extent, scale) are
one-row aggregates broadcast into the row expressions.  Rectangle and point
queries are exact (the reference's quadtree answers at cell granularity).
``overlapping_nodes`` is a grid-cell equi-join: each node is replicated
into the cells its collision box covers and candidate pairs meet only
inside a shared cell, so there is no cartesian product.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .multigraph import MultiGraph


def _nan_or_zero_to_one(c: Column) -> Column:
    return F.when(c.isNull() | F.isnan(c) | (c == 0), F.lit(1.0)).otherwise(c)


def extent(nodes: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """A10: one row ``(min_x, max_x, min_y, max_y, size_max, weight_max)``.

    A size/weight maximum that is 0 or NaN becomes 1; an empty node set
    gives NULL extents (the reference gives infinities)."""
    n = nodes.agg(F.min("x").alias("min_x"), F.max("x").alias("max_x"),
                  F.min("y").alias("min_y"), F.max("y").alias("max_y"),
                  F.max("size").alias("size_max"))
    if edges is not None and "size" in edges.columns:
        w = edges.agg(F.max("size").alias("weight_max"))
    else:
        w = nodes.sparkSession.range(1).select(F.lit(None).cast("double").alias("weight_max"))
    return n.crossJoin(w).select(
        "min_x", "max_x", "min_y", "max_y",
        _nan_or_zero_to_one(F.col("size_max").cast("double")).alias("size_max"),
        _nan_or_zero_to_one(F.col("weight_max").cast("double")).alias("weight_max"))


def rescale(g: MultiGraph, width: float = 1.0, height: float = 1.0, mode: str = "inside",
            min_node_size: float | None = None, max_node_size: float | None = None,
            min_edge_size: float | None = None, max_edge_size: float | None = None,
            side_margin: float = 0.0, ignore_size: bool = False,
            what=("nodePosition", "nodeSize", "edgeSize")) -> MultiGraph:
    """Fit the layout into a ``width`` x ``height`` box centred on 0.

    scale = min (``inside``) or max (``outside``) of ``w/dx``, ``h/dy`` with
    extents floored at 1, recomputed after growing the extent by the margin
    ``(max_node_size or size_max)/scale + side_margin``.  Sizes map affinely
    (``a*s+b``) as configured.  Adds ``rx, ry, rsize`` to nodes and
    ``rsize`` to edges."""
    for w in what:
        if w not in ("nodePosition", "nodeSize", "edgeSize"):
            raise ValueError(f"cannot rescale {w!r}: expected nodePosition, nodeSize or edgeSize")
    agg = F.greatest if mode == "outside" else F.least
    ex = extent(g.nodes, g.edges)

    def scale_of(mnx, mxx, mny, mxy):
        return agg(F.lit(float(width)) / F.greatest(mxx - mnx, F.lit(1.0)),
                   F.lit(float(height)) / F.greatest(mxy - mny, F.lit(1.0)))

    s0 = scale_of(F.col("min_x"), F.col("max_x"), F.col("min_y"), F.col("max_y"))
    margin = (F.lit(0.0) if ignore_size else
              (F.lit(float(max_node_size)) if max_node_size else F.col("size_max")) / s0) \
        + F.lit(float(side_margin or 0.0))
    p = ex.select("*", margin.alias("m"))
    p = p.select("size_max", "weight_max",
                 (F.col("min_x") - F.col("m")).alias("min_x"), (F.col("max_x") + F.col("m")).alias("max_x"),
                 (F.col("min_y") - F.col("m")).alias("min_y"), (F.col("max_y") + F.col("m")).alias("max_y"))
    p = p.select("*", scale_of(F.col("min_x"), F.col("max_x"), F.col("min_y"), F.col("max_y")).alias("scale"),
                 ((F.col("max_x") + F.col("min_x")) / 2).alias("cx"),
                 ((F.col("max_y") + F.col("min_y")) / 2).alias("cy"))

    def affine(lo, hi, top):
        if not hi and not lo:
            return F.lit(1.0), F.lit(0.0)
        if hi == lo:
            return F.lit(0.0), F.lit(float(hi))
        return F.lit(float(hi - (lo or 0))) / F.col(top), F.lit(float(lo or 0))

    a, b = affine(min_node_size, max_node_size, "size_max")
    c, d = affine(min_edge_size, max_edge_size, "weight_max")
    p = p.select("scale", "cx", "cy", a.alias("_a"), b.alias("_b"), c.alias("_c"), d.alias("_d"))
    np_, ns, es = ("nodePosition" in what), ("nodeSize" in what), ("edgeSize" in what)
    nodes = g.nodes.crossJoin(F.broadcast(p))  # one-row parameters
    nodes = nodes.select(
        *g.nodes.columns,
        ((F.col("x") - F.col("cx")) * (F.col("scale") if np_ else F.lit(1.0))).alias("rx"),
        ((F.col("y") - F.col("cy")) * (F.col("scale") if np_ else F.lit(1.0))).alias("ry"),
        (F.col("size") * (F.col("_a") if ns else F.lit(1.0)) + (F.col("_b") if ns else F.lit(0.0)))
        .alias("rsize"))
    edges = g.edges
    if "size" in edges.columns:
        edges = edges.crossJoin(F.broadcast(p.select("_c", "_d"))).select(
            *g.edges.columns,
            (F.col("size") * (F.col("_c") if es else F.lit(1.0)) + (F.col("_d") if es else F.lit(0.0)))
            .alias("rsize"))
    return MultiGraph(nodes, edges)


# ---------------------------------------------------------------------------
# rectangle and point queries


def _square_hits(x: Column, y: Column, r: Column, x1, y1, x2, y2, height) -> Column:
    """Does the square ``[x±r] x [y±r]`` meet the rectangle with side
    (x1,y1)-(x2,y2) extruded by ``height`` to its left?  Separating-axis test
    on the two coordinate axes and the two rectangle axes."""
    dx, dy = x2 - x1, y2 - y1
    ln = math.hypot(dx, dy)
    if ln == 0:
        raise ValueError("degenerate rectangle")
    ux, uy = dx / ln, dy / ln
    nx, ny = -uy, ux
    corners = [(x1, y1), (x2, y2), (x2 + nx * height, y2 + ny * height), (x1 + nx * height, y1 + ny * height)]
    cond = F.lit(True)
    for ax, ay in [(1.0, 0.0), (0.0, 1.0), (ux, uy), (nx, ny)]:
        proj = [cx * ax + cy * ay for cx, cy in corners]
        lo, hi = min(proj), max(proj)
        c = x * F.lit(ax) + y * F.lit(ay)
        half = r * F.lit(abs(ax) + abs(ay))
        cond = cond & (c - half <= F.lit(hi)) & (c + half >= F.lit(lo))
    return cond


def nodes_in_rect(nodes: DataFrame, x: float, y: float, width: float, height: float) -> DataFrame:
    """P17 (axis-aligned): nodes whose square ``[x±size, y±size]`` meets the
    rectangle ``[x, x+width] x [y, y+height]`` (inclusive)."""
    return nodes.filter((F.col("x") - F.col("size") <= x + width) & (F.col("x") + F.col("size") >= x)
                        & (F.col("y") - F.col("size") <= y + height) & (F.col("y") + F.col("size") >= y))


def nodes_in_rotated_rect(nodes: DataFrame, x1: float, y1: float, x2: float, y2: float,
                          height: float) -> DataFrame:
    """P17 (rotated): the rectangle is the side (x1,y1)-(x2,y2) extruded by
    ``height`` along its left normal."""
    return nodes.filter(_square_hits(F.col("x"), F.col("y"), F.col("size"), x1, y1, x2, y2, height))


def nodes_at(nodes: DataFrame, x: float, y: float) -> DataFrame:
    """Nodes whose square contains the point."""
    return nodes.filter((F.abs(F.col("x") - x) <= F.col("size")) & (F.abs(F.col("y") - y) <= F.col("size")))


def edge_boxes(g: MultiGraph) -> DataFrame:
    """Straight-edge bounding boxes grown by the edge size (J8 + box)."""
    e = g.edges_with_coords()
    sz = F.coalesce(F.col("size"), F.lit(0.0)) if "size" in g.edges.columns else F.lit(0.0)
    return e.select(*g.edges.columns,
                    (F.least("x1", "x2") - sz).alias("bx1"), (F.greatest("x1", "x2") + sz).alias("bx2"),
                    (F.least("y1", "y2") - sz).alias("by1"), (F.greatest("y1", "y2") + sz).alias("by2"))


def boxes_in_rect(boxes: DataFrame, x: float, y: float, width: float, height: float) -> DataFrame:
    return boxes.filter((F.col("bx1") <= x + width) & (F.col("bx2") >= x)
                        & (F.col("by1") <= y + height) & (F.col("by2") >= y))


def edges_in_rect(g: MultiGraph, x: float, y: float, width: float, height: float) -> DataFrame:
    """Edges whose grown bounding box meets the rectangle."""
    return boxes_in_rect(edge_boxes(g), x, y, width, height)


def edges_at(g: MultiGraph, x: float, y: float) -> DataFrame:
    return boxes_in_rect(edge_boxes(g), x, y, 0.0, 0.0)


# ---------------------------------------------------------------------------
# J9 collision pairs


def overlapping_nodes(nodes: DataFrame, scale_nodes: float = 1.2, node_margin: float = 5.0,
                      cell: float | None = None) -> DataFrame:
    """Pairs ``(id_a < id_b)`` whose discs overlap: ``dist < r_a + r_b``
    with ``r = size*scale_nodes + node_margin``.

    Two grids.  The fine cell edge defaults to twice the 90th-percentile
    radius (one scalar from an approximate percentile); nodes of at most that
    radius cover a few fine cells each and are joined among themselves there.
    The larger nodes, and all nodes against them, meet on a coarse grid with
    twice the largest radius as its edge, so no node covers more than a few
    cells however large it is.  Two discs that overlap have boxes that share a
    cell, so the equi-joins find every pair; a pair is reported only in the
    cell holding the lower-left corner of the boxes' intersection, so no pair
    comes twice and no ``distinct`` is needed."""
    r = F.col("size") * scale_nodes + node_margin
    pts = nodes.select("id", "x", "y", r.alias("r"))
    stats = pts.agg(F.percentile_approx("r", 0.9).alias("q"), F.max("r").alias("m")).first()
    if cell is None:
        cell = 2.0 * float(stats["q"]) if stats["q"] else 1.0
    coarse = max(2.0 * float(stats["m"] or 0.0), cell)
    small, large = pts.filter(F.col("r") <= cell), pts.filter(F.col("r") > cell)
    fine = _meet(small, small, cell).filter(F.col("id_a") < F.col("id_b"))
    if coarse <= 2.0 * cell:  # no node is larger than a fine cell
        return fine.select("id_a", "id_b")
    # each pair with a large node: from its large side, or from the smaller id if both are large
    wide = _meet(large, pts, coarse).filter(
        (F.col("r_b") <= cell) | (F.col("id_a") < F.col("id_b")))
    return fine.select("id_a", "id_b").unionByName(wide.select(
        F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b")))


def _meet(left: DataFrame, right: DataFrame, edge: float) -> DataFrame:
    """Pairs of different discs that overlap, each in one cell."""
    size = F.lit(float(edge))

    def spread(pts: DataFrame, tag: str) -> DataFrame:
        lo = [F.floor((F.col(c) - F.col("r")) / size) for c in ("x", "y")]
        hi = [F.floor((F.col(c) + F.col("r")) / size) for c in ("x", "y")]
        cells = pts.select("*", F.explode(F.sequence(lo[0], hi[0])).alias("cx")).select(
            "*", F.explode(F.sequence(lo[1], hi[1])).alias("cy"))
        return cells.select(*[F.col(c).alias(f"{c}_{tag}") for c in ("id", "x", "y", "r")], "cx", "cy")

    corner = [F.floor(F.greatest(F.col(f"{c}_a") - F.col("r_a"), F.col(f"{c}_b") - F.col("r_b")) / size)
              for c in ("x", "y")]
    distance = F.sqrt(F.pow(F.col("x_a") - F.col("x_b"), 2) + F.pow(F.col("y_a") - F.col("y_b"), 2))
    return (spread(left, "a").join(spread(right, "b"), ["cx", "cy"])
            .filter((F.col("id_a") != F.col("id_b")) & (corner[0] == F.col("cx")) & (corner[1] == F.col("cy")))
            .filter(distance < F.col("r_a") + F.col("r_b")))

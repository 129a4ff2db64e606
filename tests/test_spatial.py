"""Layout-space operators against brute force."""

import math
import random

import pytest

from topicgraph.operators import spatial as SP
from topicgraph.operators.multigraph import MultiGraph


def _nodes(spark, n=400, seed=7):
    rnd = random.Random(seed)
    rows = [(f"v{i:03d}", rnd.uniform(0, 50), rnd.uniform(0, 50), rnd.choice([0.2, 0.5, 1.0, 4.0]))
            for i in range(n)]
    return rows, spark.createDataFrame(rows, "id string, x double, y double, size double")


def test_overlapping_matches_brute_force(spark):
    rows, df = _nodes(spark)
    got = {(r["id_a"], r["id_b"]) for r in SP.overlapping_nodes(df, 1.2, 0.3).collect()}
    want = set()
    for a in rows:
        for b in rows:
            if a[0] < b[0] and math.dist(a[1:3], b[1:3]) < (a[3] * 1.2 + 0.3) + (b[3] * 1.2 + 0.3):
                want.add((a[0], b[0]))
    assert got == want
    plan = SP.overlapping_nodes(df, 1.2, 0.3)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def _square_meets_polygon(x, y, r, poly):
    """Brute force: separating axes of both shapes, computed independently."""
    sq = [(x - r, y - r), (x + r, y - r), (x + r, y + r), (x - r, y + r)]
    axes = [(1, 0), (0, 1)]
    for i in range(4):
        (x1, y1), (x2, y2) = poly[i], poly[(i + 1) % 4]
        axes.append((-(y2 - y1), x2 - x1))
    for ax, ay in axes:
        p1 = [px * ax + py * ay for px, py in sq]
        p2 = [px * ax + py * ay for px, py in poly]
        if max(p1) < min(p2) or max(p2) < min(p1):
            return False
    return True


def test_rotated_rect(spark):
    rows, df = _nodes(spark)
    x1, y1, x2, y2, h = 5.0, 5.0, 30.0, 20.0, 8.0
    ln = math.hypot(x2 - x1, y2 - y1)
    nx, ny = -(y2 - y1) / ln, (x2 - x1) / ln
    poly = [(x1, y1), (x2, y2), (x2 + nx * h, y2 + ny * h), (x1 + nx * h, y1 + ny * h)]
    got = {r["id"] for r in SP.nodes_in_rotated_rect(df, x1, y1, x2, y2, h).collect()}
    want = {r[0] for r in rows if _square_meets_polygon(r[1], r[2], r[3], poly)}
    assert got == want


def test_axis_rect_and_point(spark):
    rows, df = _nodes(spark)
    got = {r["id"] for r in SP.nodes_in_rect(df, 10, 10, 5, 3).collect()}
    want = {r[0] for r in rows if r[1] - r[3] <= 15 and r[1] + r[3] >= 10 and r[2] - r[3] <= 13 and r[2] + r[3] >= 10}
    assert got == want
    at = {r["id"] for r in SP.nodes_at(df, 20, 20).collect()}
    assert at == {r[0] for r in rows if abs(r[1] - 20) <= r[3] and abs(r[2] - 20) <= r[3]}


def test_extent_and_rescale(spark):
    nodes = spark.createDataFrame([("a", 0.0, 0.0, 2.0), ("b", 10.0, 4.0, 0.0)],
                                  "id string, x double, y double, size double")
    edges = spark.createDataFrame([("e", "a", "b", 0.0)], "id string, source string, target string, size double")
    ex = SP.extent(nodes, edges).first()
    assert (ex["min_x"], ex["max_x"], ex["size_max"], ex["weight_max"]) == (0.0, 10.0, 2.0, 1.0)
    g = SP.rescale(MultiGraph(nodes, edges), width=100, height=100, min_node_size=1, max_node_size=8)
    r = {x["id"]: x for x in g.nodes.collect()}
    # scale0 = min(100/10, 100/4) = 10; margin = 8/10; scale = min(100/11.6, 100/5.6)
    scale = 100 / 11.6
    assert r["b"]["rx"] == pytest.approx((10 - 5) * scale)
    assert r["a"]["ry"] == pytest.approx((0 - 2) * scale)
    assert r["a"]["rsize"] == pytest.approx(2 * 7 / 2 + 1)
    with pytest.raises(ValueError):
        SP.rescale(MultiGraph(nodes, edges), what=("bogus",))

import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from topicgraph.operators import spatial, spatial_store as SS
from topicgraph.operators.multigraph import MultiGraph
from topicgraph.session import scratch_path


@pytest.fixture(scope="module")
def layout(spark):
    rnd = random.Random(11)
    nodes = [(f"n{i}", rnd.uniform(-50, 50), rnd.uniform(0, 30), rnd.choice([0.0, 0.1, 0.5, 0.5, 9.0])) for i in range(400)]
    nodes += [("big", 3.0, 3.0, 80.0), ("corner", -50.0, 0.0, 0.0), ("none", None, 1.0, 1.0), ("nan", float("nan"), 1.0, 1.0)]
    edges = [(f"e{i}", f"n{rnd.randrange(400)}", f"n{rnd.randrange(400)}", rnd.choice([None, 0.0, 2.0])) for i in range(300)]
    g = MultiGraph(spark.createDataFrame(nodes, "id string, x double, y double, size double").cache(),
                   spark.createDataFrame(edges, "id string, source string, target string, size double").cache())
    return g, SS.build_nodes(g.nodes, scratch_path(spark, "nodes")), SS.build_edges(g, scratch_path(spark, "edges"))


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


RECTS = [(0, 0, 5, 5), (-50, 0, 0, 0), (-60, -10, 200, 100), (49.5, 29.5, 3, 3), (200, 200, 5, 5), (-20, 10, 0.01, 0.01), (10, 3, 30, 1)]


@pytest.mark.parametrize("rect", RECTS)
def test_rectangles(layout, rect):
    g, nodes, edges = layout
    placed = g.nodes.filter("x IS NOT NULL AND NOT isnan(x)")
    assert ids(nodes.nodes_in_rect(*rect)) == ids(spatial.nodes_in_rect(placed, *rect))
    assert ids(edges.edges_in_rect(*rect)) == ids(spatial.edges_in_rect(g, *rect))


@pytest.mark.parametrize("rect", [(0, 0, 10, 5, 4), (-30, 20, -10, 25, 3), (0, 0, 0, 10, 2)])
def test_rotated(layout, rect):
    g, nodes, _ = layout
    placed = g.nodes.filter("x IS NOT NULL AND NOT isnan(x)")
    assert ids(nodes.nodes_in_rotated_rect(*rect)) == ids(spatial.nodes_in_rotated_rect(placed, *rect))


def test_points(layout):
    g, nodes, edges = layout
    placed = g.nodes.filter("x IS NOT NULL AND NOT isnan(x)")
    for x, y in ((3.0, 3.0), (-50.0, 0.0), (20.0, 15.0), (500.0, 0.0)):
        assert ids(nodes.nodes_at(x, y)) == ids(spatial.nodes_at(placed, x, y))
        assert ids(edges.edges_at(x, y)) == ids(spatial.edges_at(g, x, y))
    with pytest.raises(ValueError):
        nodes.nodes_in_rotated_rect(1, 1, 1, 1, 5)


def test_no_elements(spark, layout):
    empty = SS.build_nodes(layout[0].nodes.limit(0), scratch_path(spark, "nodes"))
    assert empty.nodes_in_rect(0, 0, 1, 1).count() == 0
    one = SS.build_nodes(layout[0].nodes.filter("id = 'big'"), scratch_path(spark, "nodes"))
    assert ids(one.nodes_at(3.0, 3.0)) == ["big"] and ids(one.nodes_in_rect(80, 80, 1, 1)) == ["big"]


def test_ranges_cover_the_cells():
    def z(x, y):
        return SS._range(x, y, 0)[0]

    rnd = random.Random(1)
    for most in (4, 9, 40):
        for _ in range(20):
            x, y = rnd.randrange(60000), rnd.randrange(60000)
            w, h = rnd.randrange(40), rnd.randrange(40)
            got = SS.z_ranges(x, x + w, y, y + h, most)
            assert len(got) <= most and all(a <= b for a, b in got) and all(b + 1 < c for (_, b), (c, _) in zip(got, got[1:]))
            assert all(any(a <= z(i, j) <= b for a, b in got) for i in range(x, x + w + 1) for j in range(y, y + h + 1))
    assert SS.z_ranges(0, 65535, 0, 65535, 10) == [(0, 2 ** 32 - 1)]


def groups_read(store, *rect):
    """Row groups whose keys meet the ranges, and all."""
    ranges, hit, every = store.key_ranges(*rect), 0, 0
    for f in glob.glob(f"{store.path.removeprefix('file:')}/elements/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for i in range(meta.num_row_groups):
            col = next(c for c in (meta.row_group(i).column(k) for k in range(meta.num_columns)) if c.path_in_schema == "key")
            every += 1
            hit += any(a <= col.statistics.max and b >= col.statistics.min for a, b in ranges)
    return hit, every


def test_row_groups_fall_with_the_area(spark):
    n = 60_000
    nodes = spark.range(n).select(F.concat(F.lit("n"), "id").alias("id"), ((F.col("id") * 7919) % 1009 / 10.0).alias("x"),
                                  ((F.col("id") * 104729) % 1013 / 10.0).alias("y"), (F.col("id") % 3 / 100.0).alias("size"))
    store = SS.build_nodes(nodes, scratch_path(spark, "nodes"), row_group=1 << 14)
    seen = [groups_read(store, 20.0, 20.0 + s, 20.0, 20.0 + s) for s in (200.0, 40.0, 10.0, 1.0)]
    assert seen[0][1] > 40 and seen[0][0] > seen[0][1] * 0.5
    assert seen[1][0] < 0.45 * seen[0][1] and seen[2][0] < 0.15 * seen[0][1] and seen[3][0] < 0.1 * seen[0][1]
    plan = store.nodes_in_rect(20, 20, 1, 1)._jdf.queryExecution().executedPlan().toString()
    assert "Or(" in plan.split("PushedFilters: [")[1].split("ReadSchema")[0]

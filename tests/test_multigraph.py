"""Directed multigraph (FIXTURES §4), filters, ego-nets, HITS, paths."""

import heapq
import json
import math

import pytest
from pyspark.sql import functions as F

from topicgraph.operators.centrality import hits
from topicgraph.operators.filters import FilterChain
from topicgraph.operators.multigraph import MultiGraph
from topicgraph.operators.paths import path_length, shortest_path, shortest_paths

NODES = [("c", "C", 0.0, 0.0, 1.0), ("n1", "N1", 1.0, 0.0, 1.0), ("n2", "N2", 0.0, 2.0, 2.0),
         ("n3", "N3", 3.0, 3.0, 1.0), ("iso", "I", 9.0, 9.0, 1.0), ("far", "F", 5.0, 0.0, 1.0)]
EDGES = [("e1", "c", "n1", 1.0), ("e2", "c", "n1", 2.0),      # parallel
         ("e3", "n1", "c", 1.0),                               # reversed pair
         ("e4", "c", "c", 1.0),                                # loop on the centre
         ("e5", "n2", "n2", 1.0),                              # loop on a neighbour
         ("e6", "n2", "c", 1.0), ("e7", "n1", "n2", 1.0),      # neighbour-neighbour
         ("e8", "n3", "n1", 1.0), ("e9", "far", "n3", 1.0)]


@pytest.fixture
def g(spark):
    return MultiGraph(spark.createDataFrame(NODES, "id string, label string, x double, y double, size double"),
                      spark.createDataFrame(EDGES, "id string, source string, target string, size double"))


def test_degrees(g):
    d = {r["id"]: (r["in_degree"], r["out_degree"], r["degree"]) for r in g.degrees().collect()}
    assert d["c"] == (3, 3, 6)            # e1 e2 e4 out, e3 e4 e6 in
    assert d["n2"] == (2, 2, 4)
    assert d["iso"] == (0, 0, 0)


def test_validation(spark, g):
    bad = MultiGraph(
        spark.createDataFrame([("a", "A", 0.0, 0.0, 1.0), ("a", "A2", 0.0, 0.0, 1.0)],
                              "id string, label string, x double, y double, size double"),
        spark.createDataFrame([("x", "a", "zz", 1.0), ("x", "yy", "a", 1.0)],
                              "id string, source string, target string, size double"))
    v = sorted((r["kind"], r["id"]) for r in bad.validate().collect())
    assert v == [("dangling_source", "x"), ("dangling_target", "x"), ("duplicate_edge", "x"),
                 ("duplicate_node", "a")]
    with pytest.raises(ValueError):
        bad.check()
    assert g.validate().count() == 0


def test_lookup_and_drop(g):
    rows = g.lookup_nodes(["n2", "nope", "c"]).collect()
    assert [r["id"] for r in rows] == ["n2", None, "c"]
    g2 = g.drop_nodes(["n1"])
    assert sorted(r["id"] for r in g2.edges.collect()) == ["e4", "e5", "e6", "e9"]
    with pytest.raises(ValueError):
        g.drop_nodes(["nope"])
    assert g.drop_edges(["e1", "e2"]).edges.count() == len(EDGES) - 2
    with pytest.raises(ValueError):
        g.drop_edges(["nope"])


def test_adjacency(g):
    assert sorted(r["id"] for r in g.adjacent_nodes("c").collect()) == ["c", "n1", "n2"]
    assert sorted(r["id"] for r in g.adjacent_edges("c").collect()) == ["e1", "e2", "e3", "e4", "e6"]


def test_neighborhood_loop_rule(g):
    ego = g.neighborhood("c")
    assert sorted(r["id"] for r in ego.nodes.collect()) == ["c", "n1", "n2"]
    assert {r["id"]: r["center"] for r in ego.nodes.collect()}["c"] is True
    # centre loop kept, neighbour loop dropped, neighbour-neighbour kept
    assert sorted(r["id"] for r in ego.edges.collect()) == ["e1", "e2", "e3", "e4", "e6", "e7"]
    assert g.neighborhood("unknown").nodes.count() == 0


def test_filter_chain_apply_undo_export(g):
    deg = g.degrees().select("id", "degree")
    base = MultiGraph(g.nodes.join(deg, "id"), g.edges)
    fc = FilterChain(base).nodes_by("degree >= 2", "deg").edges_by("size < 2", "thin")
    out = fc.apply()
    hidden_n = sorted(r["id"] for r in out.nodes.filter("hidden").collect())
    assert hidden_n == ["far", "iso"]
    hidden_e = sorted(r["id"] for r in out.edges.filter("hidden").collect())
    assert hidden_e == ["e2", "e9"]
    with pytest.raises(ValueError):
        fc.nodes_by("true", "deg")
    with pytest.raises(ValueError):
        fc.nodes_by("true", "undo")
    restored = fc.undo().apply()
    assert restored.nodes.filter("hidden").count() == 0 and restored.edges.filter("hidden").count() == 0
    partial = fc.undo("thin").apply()
    assert sorted(r["id"] for r in partial.edges.filter("hidden").collect()) == ["e9"]
    again = FilterChain.import_chain(base, json.dumps(fc.export())).apply()
    assert sorted(r["id"] for r in again.edges.filter("hidden").collect()) == hidden_e
    with pytest.raises(ValueError):
        FilterChain.import_chain(base, [{"key": "k", "processor": "bogus", "predicate": "true"}])
    nb = FilterChain(base).neighbors_of("n3").apply()
    assert sorted(r["id"] for r in nb.nodes.filter("NOT hidden").collect()) == ["far", "n1", "n3"]


def hits_reference(nodes, edges, undirected=False, eps=1e-4, max_iter=1000):
    """Plain-Python statement of the HITS rules, for comparison."""
    ins, outs, alls = {n: set() for n in nodes}, {n: set() for n in nodes}, {n: set() for n in nodes}
    indeg = {n: 0 for n in nodes}
    outdeg = {n: 0 for n in nodes}
    for s, t in edges:
        outs[s].add(t); ins[t].add(s); alls[s].add(t); alls[t].add(s)
        outdeg[s] += 1; indeg[t] += 1
    auth_l = [n for n in nodes if undirected or indeg[n] > 0]
    hub_l = [n for n in nodes if undirected or outdeg[n] > 0]
    res = {n: (1.0, 1.0) for n in nodes}
    for _ in range(max_iter):
        tmp = {}
        for v in auth_l:
            nb = alls[v] if undirected else ins[v]
            tmp[v] = [1.0 + sum(res[j][1] for j in nb if j != v), 0.0]
        for v in hub_l:
            nb = alls[v] if undirected else outs[v]
            tmp.setdefault(v, [0.0, 0.0])[1] = 1.0 + sum(res[j][0] for j in nb if j != v)
        sa = sum(tmp[v][0] for v in auth_l)
        sh = sum(tmp[v][1] for v in hub_l)
        done = True
        for v in auth_l:
            tmp[v][0] /= sa
            if abs((tmp[v][0] - res[v][0]) / res[v][0]) >= eps:
                done = False
        for v in hub_l:
            tmp[v][1] /= sh
            if abs((tmp[v][1] - res[v][1]) / res[v][1]) >= eps:
                done = False
        res = {k: tuple(v) for k, v in tmp.items()}
        if done:
            break
    return res


@pytest.mark.parametrize("undirected", [False, True])
def test_hits_matches_reference_rules(g, undirected):
    got, rounds = hits(g.nodes, g.edges, undirected=undirected, return_rounds=True)
    got = {r["id"]: (r["authority"], r["hub"]) for r in got.collect()}
    want = hits_reference([n[0] for n in NODES], [(e[1], e[2]) for e in EDGES], undirected)
    assert set(got) == set(want)
    for k in want:
        assert got[k][0] == pytest.approx(want[k][0], abs=1e-9)
        assert got[k][1] == pytest.approx(want[k][1], abs=1e-9)
    assert sum(v[0] for v in got.values()) == pytest.approx(1.0)
    assert sum(v[1] for v in got.values()) == pytest.approx(1.0)
    if not undirected:
        assert "iso" not in got


def dijkstra(adj, src):
    dist = {src: 0.0}
    pq = [(0.0, src)]
    while pq:
        d, u = heapq.heappop(pq)
        if d > dist[u]:
            continue
        for v, w in adj.get(u, []):
            if d + w < dist.get(v, math.inf):
                dist[v] = d + w
                heapq.heappush(pq, (d + w, v))
    return dist


def test_shortest_paths(g):
    pos = {n[0]: (n[2], n[3]) for n in NODES}
    adj = {}
    for _, s, t, _ in EDGES:
        w = math.dist(pos[s], pos[t])
        adj.setdefault(s, []).append((t, w))
        adj.setdefault(t, []).append((s, w))
    got = {r["id"]: r["dist"] for r in shortest_paths(g, "far", "euclidean", undirected=True).collect()}
    want = dijkstra(adj, "far")
    assert set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k])
    p = shortest_path(g, "far", "n2", "euclidean", undirected=True)
    assert p[0] == "far" and p[-1] == "n2"
    assert path_length(g.nodes, p) == pytest.approx(want["n2"])
    hops = {r["id"]: r["hops"] for r in shortest_paths(g, "c").collect()}   # directed, by hops
    assert hops == {"c": 0, "n1": 1, "n2": 2}
    assert shortest_path(g, "c", "iso") is None


def test_add_method_rejects_duplicates(g):
    MultiGraph.add_method("edge_count_for_test", lambda graph: graph.edges.count())
    assert g.edge_count_for_test() == len(EDGES)
    with pytest.raises(ValueError):
        MultiGraph.add_method("edge_count_for_test", lambda graph: 0)
    with pytest.raises(ValueError):
        MultiGraph.add_method("degrees", lambda graph: 0)
    assert g.pipe(lambda graph, k: graph.nodes.count() + k, 1) == len(NODES) + 1


def test_table_forms_and_appends(spark, g):
    ids = spark.createDataFrame([("n3",), ("far",)], "id string")
    assert sorted(r["id"] for r in g.adjacent_edges_of(ids).collect()) == ["e8", "e9"]
    rows = g.lookup_edges(["e9", "zz"]).collect()
    assert [r["id"] for r in rows] == ["e9", None]
    more = g.add_nodes(spark.createDataFrame([("new", "N", 1.0, 1.0, 1.0)],
                                             "id string, label string, x double, y double, size double"))
    more = more.add_edges(spark.createDataFrame([("e10", "new", "c", 1.0)],
                                                "id string, source string, target string, size double"))
    assert more.validate().count() == 0
    with pytest.raises(ValueError):
        more.add_edges(spark.createDataFrame([("e10", "new", "ghost", 1.0)],
                                             "id string, source string, target string, size double"), check=True)
    centers = spark.createDataFrame([("c",), ("n3",)], "id string")
    ego = g.neighborhood(centers)
    assert sorted((r["center_id"], r["id"]) for r in ego.nodes.collect()) == [
        ("c", "c"), ("c", "n1"), ("c", "n2"), ("n3", "far"), ("n3", "n1"), ("n3", "n3")]


def test_egonets_of_all_nodes_match_brute_force(spark):
    import random
    rnd = random.Random(11)
    ids = [f"v{i:02d}" for i in range(30)]
    edges = [(f"e{i}", rnd.choice(ids[:4] + ids), rnd.choice(ids)) for i in range(120)]   # a few hubs
    nodes = spark.createDataFrame([(i, i, 0.0, 0.0, 1.0) for i in ids],
                                  "id string, label string, x double, y double, size double")
    g = MultiGraph(nodes, spark.createDataFrame([(a, b, c, 1.0) for a, b, c in edges],
                                                "id string, source string, target string, size double"))
    ego = g.neighborhood(nodes.select("id"))
    got = {(r["center_id"], r["id"]) for r in ego.edges.collect()}
    want = set()
    for c in ids:
        mem = {c} | {t for _, s, t in edges if s == c} | {s for _, s, t in edges if t == c}
        for eid, s, t in edges:
            if s in mem and t in mem and (s != t or s == c):
                want.add((c, eid))
    assert got == want

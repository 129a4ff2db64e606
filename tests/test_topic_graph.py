"""Topic graph, histograms, components and the report (FIXTURES §1, §5)."""

import random

import pytest
from pyspark.sql import functions as F

from topicgraph.operators import components as C
from topicgraph.operators import topic_graph as G
from topicgraph.plans.report import TopicGraph, topic_report

SCHEMA = "actor_id string, actor_name string, target_id string, target_name string, message string, time_sended timestamp_ntz"


def payments(spark, pairs, message="hot"):
    import datetime as dt
    rows = [(a, f"n{a}", b, f"n{b}", message, dt.datetime(2017, 1, 1 + i % 20)) for i, (a, b) in enumerate(pairs)]
    return spark.createDataFrame(rows, SCHEMA)


def hist(df):
    return [(r["bin"], r["value"]) for r in df.orderBy("pos").collect()]


def test_edges_nodes_degree(spark):
    p = payments(spark, [("a", "b"), ("b", "a"), ("a", "b"), ("c", "c"), ("a", "c")])
    g = TopicGraph.from_payments(p)
    e = {(r["source"], r["target"]): r["weight"] for r in g.edges.collect()}
    assert e == {("a", "b"): 3, ("c", "c"): 1, ("a", "c"): 1}
    d = {r["id"]: r["degree"] for r in G.degrees(g.edges).collect()}
    assert d == {"a": 2, "b": 1, "c": 3}          # self-loop counts 2
    assert sum(d.values()) == 2 * g.edges.count()
    s = g.summary().first()
    assert (s["nodes"], s["edges"]) == (3, 3) and s["density"] == pytest.approx(1.0)


def test_name_is_from_earliest_payment(spark):
    import datetime as dt
    rows = [("a", "late", "b", "nb", "m", dt.datetime(2017, 2, 1)),
            ("a", "early", "c", "nc", "m", dt.datetime(2017, 1, 1))]
    n = {r["id"]: r["name"] for r in G.build_nodes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert n["a"] == "early"


def star(spark, k, centre="h"):
    return payments(spark, [(centre, f"l{i:02d}") for i in range(k)])


def test_degree_histogram_boundaries(spark):
    h20 = hist(G.degree_histogram(G.degrees(G.build_edges(star(spark, 20)))))
    assert [b for b, _ in h20] == [str(i) for i in range(1, 21)]
    assert h20[0] == ("1", 20.0) and h20[1] == ("2", 0.01) and h20[-1] == ("20", 1.0)
    h21 = hist(G.degree_histogram(G.degrees(G.build_edges(star(spark, 21)))))
    assert [b for b, _ in h21] == [str(i) for i in range(1, 20)] + ["20+"]
    assert h21[-1] == ("20+", 1.0) and h21[0] == ("1", 21.0)


def test_component_histogram_and_top_communities(spark):
    pairs = [("big", f"b{i:02d}") for i in range(20)]               # 21 nodes
    for c in range(11):                                              # eleven of 5
        pairs += [(f"s{c:02d}a", f"s{c:02d}{x}") for x in "bcde"]
    p = payments(spark, pairs)
    g = TopicGraph.from_payments(p)
    comp = g.components()
    sizes = C.component_sizes(comp)
    h = hist(C.component_histogram(sizes))
    assert [b for b, _ in h] == [str(i) for i in range(2, 20)] + ["20+"]
    assert dict(h)["5"] == 11.0 and dict(h)["20+"] == 1.0 and dict(h)["2"] == 0.01
    top = C.top_communities(sizes).orderBy("group").collect()
    assert len(top) == 10 and top[0]["size"] == 21 and top[0]["group"] == 0
    # ties broken by component id: the first nine of the eleven size-5 ones
    assert [r["component"] for r in top[1:]] == [f"s{c:02d}a" for c in range(9)]


def test_self_loops_only_give_empty_component_histogram(spark):
    g = TopicGraph.from_payments(payments(spark, [("a", "a"), ("b", "b")]))
    sizes = C.component_sizes(g.components())
    assert C.component_histogram(sizes).count() == 0
    assert sorted(r["size"] for r in sizes.collect()) == [1, 1]


def union_find(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    groups = {}
    for n in nodes:
        groups.setdefault(find(n), []).append(n)
    return {n: min(g) for g in groups.values() for n in g}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_match_union_find(spark, seed):
    rnd = random.Random(seed)
    n = 300
    nodes = [f"v{i:03d}" for i in range(n)]
    edges = [(rnd.choice(nodes), rnd.choice(nodes)) for _ in range(260)]
    # a long path exercises many contraction rounds
    edges += [(f"v{i:03d}", f"v{i + 1:03d}") for i in range(200, 260)]
    ndf = spark.createDataFrame([(x,) for x in nodes], "id string")
    edf = spark.createDataFrame(edges, "source string, target string")
    got = {r["id"]: r["component"] for r in C.connected_components(ndf, edf).collect()}
    want = union_find(nodes, edges)
    assert got == want
    # no edge crosses components
    assert all(got[a] == got[b] for a, b in edges)


def test_report_on_fixture_window(spark):
    from topicgraph.sources.payments import payments as view
    rep = topic_report(view(spark, "/root/testdata/sf0.001"), "hot", "1997-01-01", "1997-04-01")
    s = rep.summary.first()
    assert (s["nodes"], s["edges"]) == (52, 36)
    sizes = sorted((r["size"] for r in rep.top_communities.collect()), reverse=True)
    assert sizes[:4] == [13, 5, 4, 3]
    assert rep.examples.count() == 20
    assert rep.top_users.count() == 10
    rep.release()


def test_empty_match_gives_empty_report(spark):
    from topicgraph.sources.payments import payments as view
    rep = topic_report(view(spark, "/root/testdata/sf0.001"), "zzzz-nothing", "1997-01-01", "1997-04-01")
    assert rep.summary.first()["nodes"] == 0
    assert rep.degree_bars.count() == 0 and rep.component_bars.count() == 0
    assert rep.top_users.count() == 0 and rep.community_edges.count() == 0


@pytest.mark.parametrize("seed", [5, 6])
def test_one_pass_degrees_and_names_agree(spark, seed):
    rnd = random.Random(seed)
    ids = [f"u{i}" for i in range(40)]
    p = payments(spark, [(rnd.choice(ids), rnd.choice(ids)) for _ in range(150)])
    g = TopicGraph.from_payments(p)
    two = {r["id"]: (r["name"], r["degree"]) for r in
           G.degrees(g.edges).join(g.nodes, "id").collect()}
    one = {r["id"]: (r["name"], r["degree"]) for r in G.degrees_and_names(p).collect()}
    assert one == two
    assert [tuple(r) for r in G.top_users_from_payments(p).collect()] == \
        [tuple(r) for r in G.top_users(G.degrees(g.edges), g.nodes).collect()]


def test_histogram_mass_equals_node_count(spark):
    rnd = random.Random(9)
    ids = [f"u{i}" for i in range(60)]
    p = payments(spark, [(rnd.choice(ids[:5]), rnd.choice(ids)) for _ in range(200)])
    deg = G.degrees(G.build_edges(p))
    mass = sum(v for _, v in hist(G.degree_histogram(deg)) if v >= 1)
    assert mass == deg.count()


def test_pages_stream_the_result(spark):
    from topicgraph.operators.search import pages
    df = spark.range(25).repartition(3)
    got = list(pages(df, 10))
    assert [len(p) for p in got] == [10, 10, 5]
    assert sorted(r.id for p in got for r in p) == list(range(25))


def test_explained_search_reads_stored_tokens(spark):
    from topicgraph.functions import text
    from topicgraph.operators import search
    rows = [("1", "hot tea", "2017-01-01"), ("2", "hot hot pot", "2017-01-02"), ("3", "...", "2017-01-03"), ("4", "cold", "2017-01-04")]
    docs = spark.createDataFrame(rows, "doc_id string, message string, t string").selectExpr(
        "doc_id", "message", "cast(t AS timestamp_ntz) AS time_sended")
    stored = docs.withColumn("tokens", text.analyze("message")).withColumn("month", F.lit("2017-01-01").cast("date"))
    a = search.explained_search(docs, "hot", "2017-01-01").collect()
    b = search.explained_search(stored, "hot", "2017-01-01", tokens="tokens").collect()
    assert a == b and [r.doc_id for r in a] == ["2", "1"]
    # the message without a term is no document of the field
    assert a[0].explanation[0].n_docs == 3 and a[0].explanation[0].avgdl == 2.0

"""What is stored is made once, whatever is then read from it; work that grows with the input is dealt by bytes."""

import json
import os

import pytest
from pyspark.sql import functions as F

from topicgraph.operators import adjacency, postings, spatial_store
from topicgraph.operators import search as S
from topicgraph.operators.multigraph import MultiGraph
from topicgraph.plans import catalog
from topicgraph.session import scratch_path
from topicgraph.sources import byte_ranges as BR
from topicgraph.sources import graph_files as GF
from topicgraph.sources import ingest

N = 400


@pytest.fixture
def counted(spark):
    """``counted(df)`` is ``df`` that counts its rows each time they are made."""
    made = spark.sparkContext.accumulator(0)

    def wrap(df):
        def count(batches):
            for b in batches:
                made.add(b.num_rows)
                yield b
        return df.mapInArrow(count, df.schema)

    wrap.made = made
    return wrap


def graph(spark):
    nodes = spark.range(20).selectExpr("cast(id AS string) AS id", "concat('n', id) AS label", "cast(id AS double) AS x",
                                       "cast(id % 5 AS double) AS y", "1.0D AS size")
    edges = spark.range(N).selectExpr("concat('e', id) AS id", "cast(id % 20 AS string) AS source",
                                      "cast(id * 7 % 19 AS string) AS target", "1.0D AS size")
    return MultiGraph(nodes, edges)


def test_adjacency_makes_its_edges_once(spark, counted):
    g = graph(spark)
    adj = adjacency.build(MultiGraph(g.nodes, counted(g.edges)), scratch_path(spark, "once"), buckets=4, limit=7)
    assert counted.made.value == N
    assert adj.edges("out").count() == adj.edges("in").count() == N
    assert sorted(adj.nodes.select(*g.degrees().columns).collect()) == sorted(g.degrees().collect())


def test_links_make_their_pairs_once(spark, counted):
    g = graph(spark)
    adj = adjacency.build(g, scratch_path(spark, "once"), buckets=4)
    links = adj.links(scratch_path(spark, "links"), undirected=True)
    want = {tuple(p) for r in g.edges.collect() if r.source != r.target for p in ((r.source, r.target), (r.target, r.source))}
    assert {(r.source, r.target) for r in links.edges().collect()} == want and links.edges().count() == len(want)


def test_layout_makes_its_elements_once(spark, counted):
    g = graph(spark)
    store = spatial_store.build_edges(MultiGraph(g.nodes, counted(g.edges)), scratch_path(spark, "layout"))
    assert counted.made.value == N and store.elements().count() == N


def test_index_makes_its_documents_once(spark, counted):
    docs = spark.range(N).selectExpr("cast(id AS string) AS doc_id", "concat('hot gear ', id % 7) AS message",
                                     "timestamp_ntz'1997-01-01 00:00:00' AS time_sended")
    index = postings.build(counted(docs), scratch_path(spark, "index"))
    assert counted.made.value == N and index.prefix("ho").count() == N


def test_ingest_makes_its_payments_once(spark, counted):
    rows = spark.range(N).selectExpr(
        "'a' AS actor_id", "'A' AS actor_name", "'b' AS target_id", "'B' AS target_name", "'hot gear' AS message",
        "timestamp_ntz'1997-01-01 00:00:00' + make_dt_interval(cast(id % 390 % 300 AS int)) AS time_sended", "'f' AS file_path",
        "cast(id % 390 AS string) AS doc_id")
    out = scratch_path(spark, "stored")
    ingest.write_payments(counted(rows), out, "load", grain="month")
    got = ingest.read_index(spark, out)
    assert counted.made.value == N and got.count() == got.select("doc_id").distinct().count() == N


def test_ranges_are_dealt_by_bytes(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "g.json")
    with open(path, "w") as f:
        json.dump({"nodes": [{"id": str(i)} for i in range(500)], "edges": []}, f)
    cut = BR.ranges(spark, path, 50)
    assert cut.count() > 100 and cut.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
    monkeypatch.setattr(BR, "TASK", 300)
    want = -(-os.path.getsize(path) // 300)
    assert want > 4 * spark.sparkContext.defaultParallelism and BR.ranges(spark, path, 50).rdd.getNumPartitions() == want
    # rows that stand for bytes are not merged for being small
    found = BR.json_elements(spark, path, 2, 50)
    assert found.count() == 500 and found.rdd.getNumPartitions() == want


def test_heads_of_large_documents(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(BR, "STEP", 40)
    meta = '<meta lastmodifieddate="2017"><creator>é &lt;graph&gt;</creator></meta>'
    body = "<nodes>" + '<node id="a"/><!-- </graph> -->' * 30 + "</nodes><edges/>"
    for name, text in (("before", f'{meta}<graph mode="static" defaultedgetype="directed">{body}</graph>'),
                       ("behind", f'<!-- <graph> --><graph defaultedgetype="mutual">{body}</graph>{meta}'),
                       ("empty", f'<graph mode="dynamic"/>{meta}'), ("none", meta)):
        with open(os.path.join(tmp_dir, f"{name}.gexf"), "w", encoding="utf-8") as f:
            f.write(f'<?xml version="1.0" encoding="UTF-8"?>\n<gexf version="1.2">{text}</gexf>')
    want = GF._xml(spark, tmp_dir, "gexf", GF._HEAD).select("*", F.col("_metadata.file_path").alias("file"))
    heads = BR.xml_heads(spark, tmp_dir, "gexf", "graph")
    assert max(len(r.head) for r in heads.collect()) < 200
    got = heads.select(F.from_xml("head", GF._HEAD).alias("h"), "file").select("h.*", "file")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 4


def test_generated_ids_parse_the_documents_once(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "g.gexf"), "w") as f:
        f.write('<gexf version="1.2"><graph><nodes/><edges><edge source="a" target="b"/><edge id="1" source="a" target="b"/>'
                '<edge source="a" target="b"/></edges></graph></gexf>')
    edges = GF.gexf_to_graph(GF.read_gexf(spark, tmp_dir)).edges
    assert edges._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    ids = [r.id for r in edges.collect()]
    assert len(set(ids)) == 3 and "1" in ids


def test_cypher_moves_what_is_asked_for(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "c.json"), "w") as f:
        json.dump({"results": [{"data": [{"graph": {"nodes": [{"id": "1", "labels": ["P"], "properties": {"k": "v"}}], "relationships": [
            {"id": i, "type": t, "startNode": "1", "endNode": "1", "properties": {}}]}} for i, t in (("r", "A"), ("r", "B"), ("s", "C"))]}]}, f)
    g = GF.read_cypher_result(spark, tmp_dir)
    plan = g.edges.select("id", "type")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("min_by(") == 1
    assert sorted(map(tuple, g.edges.select("id", "type").collect())) == [("r", "A"), ("s", "C")]


def test_cypher_documents_meet_as_rows_in_tasks_of_a_bounded_size(spark, tmp_dir, monkeypatch):
    for name, rows in {
            "customer": "SELECT id AS c_custkey, concat('c', id) AS c_name FROM range(5)",
            "part": "SELECT id AS p_partkey, 'hot gear' AS p_name FROM range(3)",
            "orders": "SELECT id AS o_orderkey, id % 5 AS o_custkey, date'1997-01-01' AS o_orderdate FROM range(200)",
            "lineitem": "SELECT id AS l_orderkey, id % 3 AS l_partkey, id % 2 AS l_suppkey, 1 AS l_linenumber, 'N' AS l_returnflag "
                        "FROM range(200)"}.items():
        spark.sql(rows).write.parquet(f"{tmp_dir}/{name}.parquet")
    monkeypatch.setattr(catalog, "CYPHER_ROWS", 10)
    docs = catalog._cypher_documents(spark, tmp_dir)
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_collect_list") < plan.index("Exchange")  # lists are made behind the shuffle
    assert "REPARTITION_BY_NUM" in plan and docs.rdd.getNumPartitions() == 1 + 21 // catalog.CYPHER_TASK
    assert 1 < docs.count() <= 21 and docs.select("b").distinct().count() == docs.count()
    assert catalog.q_cypher_edges(spark, tmp_dir).count() == 200 and catalog.q_cypher_nodes(spark, tmp_dir).count() == 5


def test_graph_of_several_documents(spark, tmp_dir):
    g, path = graph(spark), os.path.join(tmp_dir, "docs")
    GF.write_graph_json_documents(MultiGraph(g.nodes, g.edges.withColumn("label", F.lit(None).cast("string"))), path, size=100)
    assert len([d for d in os.listdir(path) if d.startswith("b=")]) == 5
    for kw in ({}, dict(split=0, ranges=64)):
        back = GF.read_graph_json(spark, path, **kw)
        assert sorted(back.edges.select(*g.edges.columns).collect()) == sorted(g.edges.collect())
        assert sorted(back.nodes.select(*g.nodes.columns).collect()) == sorted(g.nodes.collect())
    none = os.path.join(tmp_dir, "none")
    GF.write_graph_json_documents(MultiGraph(g.nodes.limit(0), g.edges.limit(0)), none)
    assert GF.read_graph_json(spark, none).nodes.count() == 0


def test_all_pages_are_those_of_the_cursor(spark):
    rows = spark.range(101).selectExpr("cast(id AS string) AS doc_id",
                                       "CASE WHEN id % 10 > 0 THEN timestamp_ntz'1997-01-01 00:00:00' + make_dt_interval(cast(id % 7 AS int)) END AS time_sended")
    want, after, number = [], None, 0
    while number == 0 or after is not None:
        page, after = S.page(rows, 9, after)
        want += [(number, r.doc_id) for r in page]
        number += 1
    assert sorted((r.page, r.doc_id) for r in S.all_pages(rows, 9).collect()) == sorted(want)


def test_paged_search_needs_one_page(spark, monkeypatch):
    import __spark_entry__ as E
    from tests.conftest import SF001
    from topicgraph.plans import catalog

    calls, page = [], S.page
    monkeypatch.setattr(catalog, "PAGE", 5)
    monkeypatch.setattr(S, "page", lambda *a, **kw: calls.append(1) or page(*a, **kw))
    rows = E.queries()["paged_search"](spark, SF001).collect()
    assert len(calls) == 1 and len(rows) == 36
    assert [r.page for r in sorted(rows, key=lambda r: (r.time_sended, r.payment_id))] == [i // 5 for i in range(36)]

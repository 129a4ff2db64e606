"""What a job leaves on the disks: results, and not the shuffles, copies and plain texts that they were made from."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from topicgraph.operators import adjacency, postings
from topicgraph.operators import search as S
from topicgraph.operators.centrality import hits_stored
from topicgraph.operators.multigraph import MultiGraph
from topicgraph.operators.paths import shortest_tree
from topicgraph.plans import catalog
from topicgraph.session import ensure_checkpoint_dir, scratch_path, written
from topicgraph.sources import byte_ranges as BR
from topicgraph.sources import graph_files as GF
from topicgraph.sources.multigraph import payment_multigraph

N = 20_000


def shuffled(spark):
    """Bytes of shuffle files and of persisted blocks."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(blocks.apply(i).length() for i in range(blocks.size()))


def scratch(spark):
    return set(os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:") + "/scratch"))


def graph(spark):
    nodes = spark.range(500).selectExpr("cast(id AS string) AS id", "cast(id % 7 AS double) AS x", "cast(id % 5 AS double) AS y", "1.0D AS size")
    edges = spark.range(N).selectExpr("concat('e', id) AS id", "cast(id % 500 AS string) AS source",
                                      "cast(id * 7 % 499 AS string) AS target", "1.0D AS size", "cast(1 + id % 3 AS double) AS length")
    return MultiGraph(nodes, edges)


@pytest.fixture
def tables(spark, tmp_dir):
    """2,000 payment lines with their tables."""
    for name, rows in {
            "customer": "SELECT id AS c_custkey, concat('c', id) AS c_name, id % 3 AS c_nationkey FROM range(50)",
            "part": "SELECT id AS p_partkey, concat('hot gear ', id) AS p_name FROM range(30)",
            "orders": "SELECT id AS o_orderkey, id % 50 AS o_custkey, timestamp_ntz'1997-01-01 00:00:00' AS o_orderdate FROM range(300)",
            "lineitem": "SELECT id div 7 AS l_orderkey, id % 30 AS l_partkey, id % 11 AS l_suppkey, id % 7 + 1 AS l_linenumber, "
                        "element_at(array('R', 'A', 'N'), cast(id % 3 + 1 AS int)) AS l_returnflag FROM range(2000)"}.items():
        spark.sql(rows).coalesce(1).write.parquet(f"{tmp_dir}/{name}.parquet")
    return tmp_dir


def test_a_written_table_goes_with_what_made_it(spark):
    spark.range(1).write.parquet(scratch_path(spark, "first"))
    before, files = shuffled(spark), scratch(spark)
    with written(spark.range(N).repartition(3).groupBy("id").count(), "made") as made:
        assert made.count() == N and len(scratch(spark) - files) == 1
        assert shuffled(spark) - before < 1000
    assert scratch(spark) == files
    with pytest.raises(ZeroDivisionError), written(spark.range(3), "made"):
        raise ZeroDivisionError
    assert scratch(spark) == files


def test_adjacency_and_rounds(spark):
    g = graph(spark)
    before = shuffled(spark)
    adj = adjacency.build(g, scratch_path(spark, "adj"))
    assert shuffled(spark) - before < 20_000
    assert adj.edges("out").count() == adj.edges("in").count() == N
    between = shuffled(spark)
    scores = hits_stored(adj, scratch_path(spark, "pairs"), undirected=True)
    assert shuffled(spark) - between < 20_000 and scores.count() == 500
    between = shuffled(spark)
    tree = shortest_tree(adj.links(scratch_path(spark, "links"), "length", undirected=True), "0")
    assert shuffled(spark) - between < 20_000 and tree.count() == 500
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_payments_do_not_move_again_to_their_targets(spark, tables):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set(keys[0], "-1")
        spark.conf.set(keys[1], "false")
        g = payment_multigraph(spark, tables)
        edges = g.edges_with_coords()
        plan = edges._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    moved = [x for x in plan.splitlines() if "Reused" not in x and ("hashpartitioning(source#" in x or "hashpartitioning(target#" in x)]
    assert len(moved) == 2      # the edges to their sources, and the nodes once
    want = {r.id: (r.x, r.y) for r in g.nodes.collect()}
    rows = edges.collect()
    assert len(rows) == 2000 and all((r.x1, r.y1) == want[r.source] and (r.x2, r.y2) == want[r.target] for r in rows)


def test_search_index(spark):
    docs = spark.range(N).selectExpr("cast(id AS string) AS doc_id", "concat('hot gear ', id % 7) AS message",
                                     "timestamp_ntz'1997-01-01 00:00:00' AS time_sended")
    spark.range(1).write.parquet(scratch_path(spark, "first"))
    before, files, path = shuffled(spark), scratch(spark), scratch_path(spark, "index")
    index = postings.build(docs, path)
    assert shuffled(spark) - before < 20_000 and scratch(spark) - files == {os.path.basename(path)}
    assert index.prefix("ho").count() == N


def test_token_rows_are_dealt_to_tasks_of_a_bounded_size(spark, tables, monkeypatch):
    monkeypatch.setattr(S, "TOKENS", 1000)
    docs = spark.range(3000).selectExpr("cast(id AS string) AS doc_id", "concat('hot gear ', id % 7) AS message",
                                        "timestamp_ntz'1997-01-01 00:00:00' AS time_sended")
    index = postings.build(docs, scratch_path(spark, "index"), block=100)
    at = []
    monkeypatch.setattr(catalog, "scratch_path", lambda s, name: at.append(scratch_path(s, name)) or at[-1])
    assert index.prefix("ho").count() == 3000 and catalog.q_token_index_search(spark, tables).count() == 2000
    for path, least in ((f"{index.path}/postings", 7), (at[-1], 6)):     # shuffle partitions: 4
        assert sum(f.startswith("part") for f in os.listdir(path.removeprefix("file:"))) >= least


def test_token_index(spark, tables):
    before = shuffled(spark)
    found = catalog.q_token_index_search(spark, tables)
    assert shuffled(spark) - before < 1000 and found.count() == found.distinct().count() == 2000


def test_rejects_of_a_stream(spark, tables, monkeypatch):
    at = {}
    monkeypatch.setattr(catalog, "scratch_path", lambda s, name: at.setdefault(name, scratch_path(s, name)))
    before = shuffled(spark)
    counts = {r.reason: r.n for r in catalog.q_stream_rejects(spark, tables).collect()}
    assert sum(counts.values()) == 2000 - 3 * 286 and counts["bad_json"] == 285
    assert shuffled(spark) - before < 20_000
    bad = at["stream_bad"].removeprefix("file:")
    files = [os.path.join(d, f) for d, _, names in os.walk(bad) for f in names if not f.startswith((".", "_"))]
    assert files and all(f.endswith(".gz") for f in files)


ROWS = [{"id": str(i), "t": "x" * (i * 37 % 300) + 'é"\\{}[]'} for i in range(700)]


def test_ranges_of_packed_documents(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(BR, "STEP", 1000)   # also what is unpacked at once
    text = json.dumps({"a": [1, {"k": 2}], "nodes": ROWS, "edges": []}, ensure_ascii=False).encode()
    for folder, put in (("plain", lambda f: open(f + ".json", "wb")), ("packed", lambda f: gzip.open(f + ".json.gz", "wb"))):
        os.mkdir(os.path.join(tmp_dir, folder))
        for name in ("f", "g"):
            with put(os.path.join(tmp_dir, folder, name)) as f:
                f.write(text)
    with open(os.path.join(tmp_dir, "packed", "g.json.gz"), "wb") as f:   # of several members
        f.write(gzip.compress(text[:5000]) + gzip.compress(text[5000:]))
    open(os.path.join(tmp_dir, "packed", "none.json.gz"), "wb").close()
    with gzip.open(os.path.join(tmp_dir, "packed", "empty.json.gz"), "wb"):
        pass
    for size in (700, 5000, 1 << 20):
        got, want = ([(os.path.basename(r.file).split(".")[0], r.offset, r.path, r.element) for r in BR.json_elements(
            spark, os.path.join(tmp_dir, folder), 2, size).collect()] for folder in ("packed", "plain"))
        assert sorted(got) == sorted(want) and len(got) == 2 * 701
        cut = BR.ranges(spark, os.path.join(tmp_dir, "packed"), size)
        assert cut.count() == 2 * -(-len(text) // size)
        tasks = cut.withColumn("task", F.spark_partition_id()).groupBy("file").agg(F.count_distinct("task").alias("n"))
        assert {r.n for r in tasks.collect()} == {1}    # a packed document is unpacked by one task


def test_packed_bytes(tmp_dir, monkeypatch):
    monkeypatch.setattr(BR, "STEP", 100)
    text, path = bytes(range(256)) * 40, os.path.join(tmp_dir, "f.gz")
    with gzip.open(path, "wb") as f:
        f.write(text)
    f = BR.Unpacked("file:" + path)
    assert f.read(50, 70) == text[50:70] and f.read(9_000, 9_010) == text[9_000:9_010] and f.read(10, 12) == text[10:12]
    f.forget(5_000)
    assert f.read(6_000, 20_000) == text[6_000:] and f.size == f.end() == len(text) and len(f.held) < 5_500
    assert f.read(3, 300) == text[3:300] and f.next(1, lambda d, i: d.find(b"\x05", i)) == 5
    assert f.read(20_000, 20_010) == b"" and f.next(20_000, lambda d, i: d.find(b"\x05", i)) == len(text)
    assert BR.Unpacked("file:" + path).end() == len(text)


def test_packed_gexf(spark, tmp_dir):
    body = "".join(f'<node id="{i}" label="é&lt;{"x" * (i % 50)}"/><!-- <node id="no"/> -->' for i in range(300))
    text = f'<gexf version="1.2"><meta lastmodifieddate="2017"/><graph defaultedgetype="directed"><nodes>{body}</nodes><edges/></graph></gexf>'
    for name, put in (("f.gexf", open), ("f.gexf.gz", gzip.open)):
        os.mkdir(os.path.join(tmp_dir, name))
        with put(os.path.join(tmp_dir, name, name), "wt", encoding="utf-8") as f:
            f.write(text)
    got, want = (GF.read_gexf(spark, os.path.join(tmp_dir, x), split=0, ranges=500) for x in ("f.gexf.gz", "f.gexf"))
    assert sorted((r.id, r.label) for r in got.nodes.collect()) == sorted((r.id, r.label) for r in want.nodes.collect())
    assert got.nodes.count() == 300


def test_cypher_documents_are_read_packed_by_ranges(spark, tables, monkeypatch):
    monkeypatch.setattr(catalog, "CYPHER_ROWS", 500)
    monkeypatch.setattr(catalog, "RANGE", dict(split=0, ranges=1 << 12))
    at = []
    monkeypatch.setattr(catalog, "scratch_path", lambda s, name: at.append(scratch_path(s, name)) or at[-1])
    got = catalog.q_cypher_ranges_edges(spark, tables)
    files = [f for _, _, names in os.walk(at[0].removeprefix("file:")) for f in names if f.startswith("part")]
    assert len(files) == 5 and all(f.endswith(".gz") for f in files)
    assert sorted(got.collect()) == sorted(catalog.q_cypher_edges(spark, tables).collect()) and got.count() == 2000

"""Loads, the ledger of stored files, compaction, aggregates and pages."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from topicgraph.functions import text
from topicgraph.operators import search as S
from topicgraph.operators import topic_graph as G
from topicgraph.plans import catalog
from topicgraph.sources import ingest
from topicgraph.sources import ledger as L
from topicgraph.streaming import ingest_stream, trend

from test_ingest import _folder, _payment


def actors(spark, out):
    return sorted(r.actor_id for r in ingest.read_index(spark, out).collect())


def put(folder, name, lines):
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines))


def test_a_file_is_stored_once_whatever_its_path(spark, tmp_dir, monkeypatch):
    src, out = _folder(tmp_dir, "src [x]", [_payment(1), _payment(1), "broken"]), os.path.join(tmp_dir, "index")
    put(src, "g.json", [_payment(2)])
    bad = os.path.join(tmp_dir, "bad")
    assert ingest.ingest(spark, L.literal(src), out, rejects_location=bad) == 2
    monkeypatch.chdir(tmp_dir)
    for path in (L.literal(src), "file:" + L.literal(src), os.path.join(tmp_dir, "src*"), os.path.join(tmp_dir, "src*", "f*"),
                 os.path.join(tmp_dir, "index", "..", "src ?x?")):
        assert ingest.ingest(spark, path, out, rejects_location=bad) == 0
    assert actors(spark, out) == ["a1", "a1", "a2"]
    assert len({r.doc_id for r in ingest.read_index(spark, out).collect()}) == 3
    put(src, "h.json", [_payment(3)])
    assert ingest.ingest(spark, os.path.join(tmp_dir, "src*"), out, rejects_location=bad) == 1
    assert actors(spark, out) == ["a1", "a1", "a2", "a3"] and spark.read.json(bad).count() == 1


def test_a_changed_file_replaces_its_rows(spark, tmp_dir):
    src, out = _folder(tmp_dir, "in", [_payment(1), _payment(2)]), os.path.join(tmp_dir, "index")
    put(src, "g.json", [_payment(3)])
    ingest.ingest(spark, src, out, aggregates=True)
    put(src, "f.json", [_payment(1), _payment(4), _payment(5)])
    assert ingest.ingest(spark, src, out, aggregates=True) == 1
    assert actors(spark, out) == ["a1", "a3", "a4", "a5"]
    assert ingest.stored_field_stats(spark, out).first().n_docs == 4
    assert sorted(r.file.rsplit("/", 1)[1] for r in L.Ledger(spark, out).files().collect()) == ["f.json", "g.json"]


def test_a_failed_write_loses_nothing(spark, tmp_dir, monkeypatch):
    src, out = _folder(tmp_dir, "in", [_payment(1)]), os.path.join(tmp_dir, "index")
    ingest.ingest(spark, src, out)
    put(src, "g.json", [_payment(2)])

    def fail(*a, **k):
        raise OSError("gone")
    for what in ("_put", "bytes_of"):
        with monkeypatch.context() as m:
            m.setattr(L, what, fail)
            with pytest.raises(OSError):
                ingest.ingest(spark, src, out)
            with pytest.raises(OSError):
                ingest.write_payments(ingest.parse_payments(ingest.read_lines(spark, src))[0], out, "other")
        assert actors(spark, out) == ["a1"]        # what was written is not live
    ingest.ingest(spark, src, out)
    assert actors(spark, out) == ["a1", "a2"]
    assert L.Ledger(spark, out).vacuum() == ["other"] and actors(spark, out) == ["a1", "a2"]


def test_compaction(spark, tmp_dir, monkeypatch):
    out, ledger = os.path.join(tmp_dir, "index"), None
    for i in range(4):
        ingest.ingest(spark, _folder(tmp_dir, f"in{i}", [_payment(i), _payment(i + 10)]), out, aggregates=True)
    ledger = L.Ledger(spark, out)
    want = actors(spark, out)
    terms = sorted(map(tuple, ingest.stored_terms(spark, out).collect()))
    assert ingest.compact(spark, out, smaller_than=1) == []
    with monkeypatch.context() as m:
        m.setattr(L, "_put", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            ingest.compact(spark, out)
    assert len(ledger.live()) == 4 and actors(spark, out) == want
    assert len(ingest.compact(spark, out)) == 4
    assert [f.load for f in ledger.live()] == ["merged"] and actors(spark, out) == want
    assert sorted(map(tuple, ingest.stored_terms(spark, out).collect())) == terms
    assert len(ledger.vacuum()) == 4 and actors(spark, out) == want and ledger.files().count() == 4
    assert ingest.ingest(spark, os.path.join(tmp_dir, "in?"), out) == 0
    assert ingest.compact(spark, out) == []


def test_named_loads_replace_themselves(spark, tmp_dir):
    out = os.path.join(tmp_dir, "index")

    def payments(*ids):
        src = _folder(tmp_dir, f"p{ids}", [_payment(i) for i in ids])
        return ingest.parse_payments(ingest.read_lines(spark, src))[0]
    ingest.write_payments(payments(1, 2), out, "a")
    ingest.write_payments(payments(3), out, "b")
    for ids in ((4,), (5, 6)):
        ingest.write_payments(payments(*ids), out, "a")
    assert actors(spark, out) == ["a3", "a5", "a6"]


def test_aggregates_equal_a_recount(spark, tmp_dir):
    out = os.path.join(tmp_dir, "index")
    a = _folder(tmp_dir, "a", [_payment(i % 3, m) for i, m in enumerate(["hot tea tea", "tea ☕", "", "hot"])])
    b = _folder(tmp_dir, "b", [_payment(i % 5, "tea") for i in range(6)])
    for src in (a, a):
        ingest.ingest(spark, src, out, aggregates=True)
    ingest_stream.start_ingest(spark, b, out, os.path.join(tmp_dir, "ck"), trigger_once=True, aggregates=True).awaitTermination(120)
    assert ingest.ingest(spark, b, out) == 0     # the ledger has the stream's files
    rows = ingest.read_index(spark, out)

    def table(df):
        return sorted(map(tuple, df.collect()))
    assert table(ingest.stored_edges(spark, out)) == table(G.build_edges(rows))
    assert table(G.degrees(ingest.stored_edges(spark, out))) == table(G.degrees(G.build_edges(rows)))
    toks = text.token_table(rows, ["doc_id"], with_synonyms=False)
    assert table(ingest.stored_terms(spark, out).select("token", "df", "tf")) == table(S.index_stats(toks))
    assert ingest.stored_field_stats(spark, out).first() == S.field_stats(rows).first()
    plan = ingest.stored_terms(spark, out)._jdf.queryExecution().executedPlan().toString()
    assert "message" not in plan and "/load=" not in plan
    ingest.ingest(spark, _folder(tmp_dir, "c", [_payment(9)]), out)
    with pytest.raises(ValueError):
        ingest.stored_terms(spark, out)


def test_stream_rejects_and_repeated_batches(spark, tmp_dir):
    src, out, bad = (os.path.join(tmp_dir, x) for x in ("in", "index", "bad"))
    _folder(tmp_dir, "in", [_payment(1), "broken", _payment(2, when='"never"')])
    for ck in ("ck1", "ck2"):    # a lost checkpoint: batch 0 comes again, its folder is live
        ingest_stream.start_ingest(spark, src, out, os.path.join(tmp_dir, ck), trigger_once=True, rejects_location=bad).awaitTermination(120)
        assert actors(spark, out) == ["a1"]
        assert sorted(r.reason for r in spark.read.json(bad).collect()) == ["bad_json", "bad_time"]


def test_table_in_the_catalog(spark, tmp_dir):
    out = os.path.join(tmp_dir, "index")
    ingest.ensure_table(spark, "ledger_table", out)
    assert spark.table("ledger_table").count() == 0
    for i in range(2):
        ingest.ingest(spark, _folder(tmp_dir, f"in{i}", [_payment(i)]), out)
        ingest.sync_table(spark, "ledger_table", out)
        assert spark.table("ledger_table").count() == i + 1
    ingest.compact(spark, out)
    ingest.sync_table(spark, "ledger_table", out)
    assert sorted(r.actor_id for r in spark.table("ledger_table").collect()) == ["a0", "a1"]
    spark.sql("DROP TABLE ledger_table")


def test_tables_without_a_ledger(spark, tmp_dir):
    out = os.path.join(tmp_dir, "index")
    good = ingest.parse_payments(ingest.read_lines(spark, _folder(tmp_dir, "in", [_payment(1)])))[0]
    ingest.with_index_columns(good).write.partitionBy("day").parquet(f"{out}/load=old")
    assert actors(spark, out) == ["a1"]


@pytest.mark.parametrize("size", [1, 3, 4, 50])
def test_pages(spark, size):
    t = dt.datetime(2017, 1, 1)
    rows = [(f"d{i}", t + dt.timedelta(hours=i // 3, microseconds=i // 6) if i % 5 else None) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id string, time_sended timestamp_ntz").withColumn("day", F.to_date("time_sended"))
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or t, r[0]))
    got, after, pages = [], None, 0
    while after is not None or not pages:
        page, after = S.page(df, size, after)
        got += [(r.doc_id, r.time_sended) for r in page]
        pages += 1
        assert len(page) <= size
    assert got == want and pages == -(-12 // size)
    assert S.page(df.limit(0), 5) == ([], None)


def test_pages_prune_days(spark, tmp_dir):
    out = os.path.join(tmp_dir, "index")
    lines = [_payment(i, when=f'"2017-01-{i + 1:02d}T10:00:00Z"') for i in range(6)]
    ingest.ingest(spark, _folder(tmp_dir, "in", lines), out)
    rows = ingest.read_index(spark, out)
    first, after = S.page(rows, 4)
    rest, end = S.page(ingest.read_index(spark, out), 4, after)
    assert [r.actor_id for r in first + rest] == [f"a{i}" for i in range(6)] and end is None


def test_exact_trend_of_a_stream(spark, tmp_dir):
    t = dt.datetime(2017, 1, 1)
    rows = [(f"u{i % 7}", f"u{i % 4}", t + dt.timedelta(hours=5 * i)) for i in range(100)]
    m = spark.createDataFrame(rows, "actor_id string, target_id string, time_sended timestamp_ntz")
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("in", "out", "ck"))
    m.repartition(3).write.parquet(src)
    for slide in (None, "12 hours"):
        stream = spark.readStream.schema(m.schema).parquet(src)
        q = (trend.topic_trend_exact_stream(stream, "1 day", slide, "1 day").writeStream.outputMode("append").format("parquet")
             .option("path", out + str(slide)).option("checkpointLocation", ck + str(slide)).trigger(availableNow=True).start())
        q.awaitTermination(120)
        got = {r.window_start: (r.payments, r.users) for r in spark.read.parquet(out + str(slide)).collect()}
        want = {r.window_start: (r.payments, r.users) for r in trend.topic_trend(m, "1 day", slide).collect()}
        last = max(r[2] for r in rows) - dt.timedelta(days=1)
        assert got == {w: v for w, v in want.items() if w + dt.timedelta(days=1) <= last} and got


@pytest.fixture
def tables(spark, tmp_dir):
    """700 payment lines of all seven shapes."""
    for name, rows in {
            "customer": "SELECT id AS c_custkey, concat('c', id) AS c_name FROM range(5)",
            "part": "SELECT id AS p_partkey, 'hot gear' AS p_name FROM range(3)",
            "orders": "SELECT id AS o_orderkey, id % 5 AS o_custkey, timestamp_ntz'1997-01-01 00:00:00' AS o_orderdate FROM range(100)",
            "lineitem": "SELECT id div 7 AS l_orderkey, id % 3 AS l_partkey, id % 2 AS l_suppkey, id % 7 + 1 AS l_linenumber, "
                        "'R' AS l_returnflag FROM range(700)"}.items():
        spark.sql(rows).coalesce(1).write.parquet(f"{tmp_dir}/{name}.parquet")
    return tmp_dir


def test_compacted_loads_after_the_merge(spark, tables, monkeypatch):
    commits, commit = [], L.Ledger.commit

    def seen(ledger, name, load, files, removes=()):
        commit(ledger, name, load, files, removes)
        commits.append((load, len(ledger.live()), len(removes)))
    monkeypatch.setattr(L.Ledger, "commit", seen)
    assert catalog.q_ingest_compacted(spark, tables).count() == 300
    assert [live for _, live, _ in commits] == [1, 2, 1, 2]     # the last one is of the folder that was not loaded before
    assert commits[2][0] == "merged" and commits[2][2] == 2 and commits[3][2] == 0


def test_compacted_merges_folders_of_any_size(spark, tables, monkeypatch):
    monkeypatch.setattr(L, "bytes_of", lambda *a: 3 << 30)      # as on large tables
    assert catalog.q_ingest_compacted(spark, tables).count() == 300

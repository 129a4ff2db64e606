"""Ingest acceptance rules (FIXTURES §2), storage and the streaming twin."""

import json
import os
import time

from pyspark.sql import functions as F

from topicgraph.sources import ingest
from topicgraph.streaming import ingest_stream

OK = {"actor": {"id": "a1", "username": "ann"},
      "transactions": [{"target": {"id": "t1", "username": "tom"}}],
      "message": "hot coffee ☕", "updated_time": "2017-01-02T15:04:00Z"}


def variant(**kw):
    d = json.loads(json.dumps(OK))
    for k, v in kw.items():
        if v is ...:
            d.pop(k)
        else:
            d[k] = v
    return json.dumps(d)


LINES = [
    ("valid", json.dumps(OK), None),
    ("second_tx", variant(transactions=[{"target": {"id": "t1", "username": "tom"}},
                                        {"target": {"id": "t9", "username": "x"}}]), None),
    ("empty_tx", variant(transactions=[]), "no_target"),
    ("target_null", variant(transactions=[{"target": None}]), "no_target"),
    ("target_string", variant(transactions=[{"target": "t1"}]), "no_target"),
    ("id_empty", variant(transactions=[{"target": {"id": "", "username": "tom"}}]), "falsy_target"),
    ("id_zero", variant(transactions=[{"target": {"id": 0, "username": "tom"}}]), "falsy_target"),
    ("id_zero_string", variant(transactions=[{"target": {"id": "0", "username": "tom"}}]), None),
    ("id_number", variant(transactions=[{"target": {"id": 12, "username": "tom"}}]), None),
    ("no_username", variant(actor={"id": "a1"}), "no_username"),
    ("null_username", variant(actor={"id": "a1", "username": None}), None),
    ("no_message", variant(message=...), "no_message"),
    ("null_message", variant(message=None), None),
    ("no_time", variant(updated_time=...), "no_time"),
    ("no_actor", variant(actor=...), "no_actor"),
    ("malformed", '{"actor": {', "bad_json"),
    ("empty", "", "bad_json"),
]


def _lines(spark):
    return spark.createDataFrame([(v, n) for n, v, _ in LINES], "value string, file_path string")


def test_acceptance_rules(spark):
    good, bad = ingest.parse_payments(_lines(spark))
    kept = {r["file_path"]: r for r in good.collect()}
    rejected = {r["file_path"]: r["reason"] for r in bad.collect()}
    for name, _, reason in LINES:
        if reason is None:
            assert name in kept, name
        else:
            assert rejected.get(name) == reason, (name, rejected.get(name))
    assert kept["second_tx"]["target_id"] == "t1"
    assert kept["null_message"]["message"] is None
    assert kept["null_username"]["actor_name"] is None
    assert kept["id_number"]["target_id"] == "12"
    assert str(kept["valid"]["time_sended"]) == "2017-01-02 15:04:00"


def test_variant_a_ignores_usernames(spark):
    good, _ = ingest.parse_payments(_lines(spark), variant="A")
    kept = {r["file_path"]: r for r in good.collect()}
    assert "no_username" in kept and kept["no_username"]["actor_name"] is None


def test_write_is_idempotent_and_pruned(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "part.json"), "w") as f:
        f.write("\n".join(v for _, v, _ in LINES))
    out = os.path.join(tmp_dir, "index")
    ingest.ingest(spark, src, out)
    ingest.ingest(spark, src, out)          # rerun replaces, never duplicates
    stored = ingest.read_index(spark, out)
    assert stored.count() == sum(1 for *_, r in LINES if r is None)
    from topicgraph.operators import search
    hit = search.match_topic(stored, "coffee", "2017-01-01", "2017-01-03", tokens="tokens")
    plan = hit._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert hit.count() == stored.filter(F.col("message").isNotNull()).count()


def test_streaming_ingest_equals_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "stream-in")
    os.makedirs(src)
    for i in range(2):
        with open(os.path.join(src, f"f{i}.json"), "w") as f:
            f.write("\n".join(v for _, v, _ in LINES))
    out, ck = os.path.join(tmp_dir, "stream-out"), os.path.join(tmp_dir, "ck")
    q = ingest_stream.start_ingest(spark, src, out, ck, trigger_once=True)
    q.awaitTermination(120)
    got = ingest.read_index(spark, out)
    good, _ = ingest.parse_payments(ingest.read_lines(spark, src))
    assert got.count() == good.count() == 2 * sum(1 for *_, r in LINES if r is None)
    assert sorted(r[0] for r in got.select("target_id").collect()) == \
        sorted(r[0] for r in good.select("target_id").collect())


def test_ensure_table_then_write(spark, tmp_dir):
    loc = os.path.join(tmp_dir, "tbl")
    ingest.ensure_table(spark, "payments_idx", loc)
    ingest.ensure_table(spark, "payments_idx", loc)          # idempotent
    cols = [f.name for f in spark.table("payments_idx").schema.fields]
    assert cols[:6] == ["actor_id", "actor_name", "target_id", "target_name", "message", "time_sended"]
    assert "day" in cols and "tokens" in cols
    spark.sql("DROP TABLE payments_idx")


def _payment(i, message="m", when='"2017-01-01T10:00:00Z"'):
    return json.dumps({"actor": {"id": f"a{i}", "username": "A"}, "transactions": [{"target": {"id": "t", "username": "T"}}],
                       "message": message})[:-1] + f', "updated_time": {when}}}'


def _folder(tmp_dir, name, lines):
    path = os.path.join(tmp_dir, name)
    os.makedirs(path)
    with open(os.path.join(path, "f.json"), "w") as f:
        f.write("\n".join(lines))
    return path


def test_loads_of_one_day_add_up(spark, tmp_dir):
    a = _folder(tmp_dir, "a", [_payment(1), _payment(2), _payment(3), "broken"])
    b = _folder(tmp_dir, "b", [_payment(4), "broken", "also broken"])
    out, bad = os.path.join(tmp_dir, "index"), os.path.join(tmp_dir, "bad")
    for path in (a, b, a):
        ingest.ingest(spark, path, out, rejects_location=bad)
    assert sorted(r.actor_id for r in ingest.read_index(spark, out).collect()) == ["a1", "a2", "a3", "a4"]
    assert spark.read.json(bad).count() == 3
    c = _folder(tmp_dir, "c", [_payment(5)])
    q = ingest_stream.start_ingest(spark, c, out, os.path.join(tmp_dir, "ck"), trigger_once=True)
    q.awaitTermination(120)
    assert ingest.read_index(spark, out).count() == 5


def test_equal_lines_are_documents_of_their_own(spark, tmp_dir):
    a = _folder(tmp_dir, "a", [_payment(1)] * 3 + [_payment(2)])
    out = os.path.join(tmp_dir, "index")
    ingest.ingest(spark, a, out)
    first = sorted(r.doc_id for r in ingest.read_index(spark, out).collect())
    ingest.ingest(spark, a, out)
    assert len(set(first)) == 4 and first == sorted(r.doc_id for r in ingest.read_index(spark, out).collect())


def test_time_forms(spark, tmp_dir):
    want = {'"2017-01-02T03:04:05Z"': "2017-01-02 03:04:05", '"2017-01-02T03:04:05.25Z"': "2017-01-02 03:04:05.250000",
            '"2017-01-02T03:04:05+00:00"': "2017-01-02 03:04:05", '"2017-01-02T03:04:05-0530"': "2017-01-02 08:34:05",
            '"2017-01-01T01:00+02:00"': "2016-12-31 23:00:00", '"2017-01-02T03"': "2017-01-02 03:00:00",
            '"2017-01-02T03:04:05"': "2017-01-02 03:04:05", '"2017-01-02"': "2017-01-02 00:00:00", '"2017-02"': "2017-02-01 00:00:00",
            '"2017"': "2017-01-01 00:00:00", "1483326245250": "2017-01-02 03:04:05.250000", '"-1000000"': "1969-12-31 23:43:20",
            "null": "None", '"2017-13-01"': None, '"2017-01-02T25:00:00Z"': None, '"yesterday"': None, '""': None}
    src = _folder(tmp_dir, "t", [_payment(i, when=w) for i, w in enumerate(want)])
    good, bad = ingest.parse_payments(ingest.read_lines(spark, src))
    got = {r.actor_id: str(r.time_sended) for r in good.collect()}
    assert got == {f"a{i}": t for i, t in enumerate(want.values()) if t is not None}
    assert [r.reason for r in bad.collect()] == ["bad_time"] * 4


def test_variant_a_stores_standard_tokens(spark, tmp_dir):
    src, out = _folder(tmp_dir, "a", [_payment(1, "Coffee-time :)")]), os.path.join(tmp_dir, "index")
    ingest.ingest(spark, src, out, variant="A")
    assert ingest.read_index(spark, out).first().tokens == ["coffee", "time"]


def test_fields_are_taken_at_once_and_say_why_a_line_is_rejected(spark):
    def line(target='{"id":7,"username":"t"}', actor='{"id":1,"username":"a"}', rest=',"message":"m","updated_time":"1997-01-01T00:00:00Z"'):
        return f'{{"actor":{actor},"transactions":[{{"target":{target}}}]{rest}}}'

    def to(value):
        return line(f'{{"id":{value},"username":"t"}}')

    cases = {line()[:40]: "bad_json", "": "bad_json", "[1]": "no_target", '{"transactions":{}}': "no_target", '{"transactions":[null]}': "no_target",
             '{"transactions":[]}': "no_target", line('"t"'): "no_target", line('{"username":"t"}'): "no_target", line(actor="5"): "no_actor",
             line(actor='{"username":"a"}'): "no_actor", line(actor='{"id":1}'): "no_username", line('{"id":7}'): "no_username",
             line(rest=',"updated_time":null'): "no_message", line(rest=',"message":null'): "no_time",
             line(rest=',"message":"m","updated_time":"x"'): "bad_time", line(rest=',"message":null,"updated_time":null'): None,
             line('{"id":7,"username":null}', '{"id":null,"username":null}'): None}
    cases |= {to(v): "falsy_target" for v in ("null", '""', "0", "-0.0", "0e5", "false", "[]", "{}", "[ ]")}
    cases |= {to(v): None for v in ('"0"', '"false"', '"[]"', "10", "0.5", "-1", "true", "[0]", '{"a":0}', '"é"', '" "', "1e3")}
    lines = spark.createDataFrame([(v, "f") for v in cases], "value string, file_path string")
    records = ingest.parse_records(lines)
    assert {r.value: r.reason for r in records.collect()} == cases
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_parse_json(") <= 1 and "StructField(id,VariantType" not in plan, plan

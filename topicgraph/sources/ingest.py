"""Payment ingest: raw JSON lines -> PAYMENT rows (+ rejects) -> parquet.

S1 ``read_lines``: ``spark.read.text`` over a glob, with the source file as
lineage.  P1/P2 ``parse_payments``: one ``try_parse_json`` per line and
``try_variant_get`` per field; Variant tells a missing key from a JSON null,
which decides whether a record is kept.  Everything is a Catalyst projection
and filter — no Python worker.  S2/S3 ``ensure_table``/``write_payments``:
parquet folders by load and ``day`` with a ledger (``ledger.py``): a file is
stored once however often and by whatever path it is loaded, a write counts when
it is whole, ``compact`` merges small folders.  With ``aggregates`` each folder
keeps its share of A1, A3 and A14, so degrees and document frequencies are sums
over folders that read no message.

Acceptance (variant "B", six fields) — a record is dropped when:
  * the line is not JSON (reason ``bad_json``; routed to rejects),
  * ``transactions[0].target`` has no ``id`` (missing list, empty list,
    target not an object, ...) (``no_target``),
  * ``actor.id`` is missing (``no_actor``),
  * ``actor.username`` or ``transactions[0].target.username`` is missing
    (``no_username``),
  * the target id is falsy: null, "", 0, false, [] or {} (``falsy_target``),
  * ``message`` or ``updated_time`` is missing (``no_message``/``no_time``),
  * ``updated_time`` is there but no time that can be read (``bad_time``).
Keys present with JSON null are kept as NULL.  Variant "A" (four fields)
ignores the usernames.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import analyze, analyze_standard, parse_iso_time
from ..session import shuffles_deleted, written
from . import ledger as L

REASONS = ("bad_json", "no_target", "no_actor", "no_username", "falsy_target",
           "no_message", "no_time", "bad_time")


def read_lines(spark: SparkSession, path: str | list[str], path_glob_filter: str | None = None) -> DataFrame:
    """``(value, file_path)`` for every line of the files under ``path``."""
    reader = spark.read.format("text")
    if path_glob_filter:
        reader = reader.option("pathGlobFilter", path_glob_filter)
    return reader.load(path).select("value", F.col("_metadata.file_path").alias("file_path"))


def _truthy(s: Column, x: Column) -> Column:
    """Python truthiness of a JSON value, as text and as a variant (null, "",
    0, false, [] and {} are falsy).  Its type is asked for only if the text
    does not settle it: what begins with 1 to 9 is no falsy value."""
    typ = F.schema_of_variant(x)
    return (F.when(s.isNull(), F.lit(False))  # missing or null
            .when(s.substr(1, 1).between("1", "9"), F.lit(True))
            .when(typ == "STRING", s != "")
            .when(typ == "BOOLEAN", s == "true")
            .when(typ.startswith("ARRAY") | typ.startswith("OBJECT"), ~s.isin("[]", "{}"))
            .otherwise(F.coalesce(s.try_cast("double") != 0, F.lit(True))))


_PARTY = "struct<id string, username string>"
_TEXTS = f"struct<actor {_PARTY}, transactions array<struct<target {_PARTY}>>, message string, updated_time string>"
#: Where the fields of a record are.
_PATHS = {"actor_id": "$.actor.id", "actor_name": "$.actor.username", "target_id": "$.transactions[0].target.id",
          "target_name": "$.transactions[0].target.username", "message": "$.message", "time_sended": "$.updated_time"}


def _value(field: str) -> Column:
    """The field as a variant, NULL only if its key is missing."""
    return F.try_variant_get("v", _PATHS[field], "variant")


def _present(field: str) -> Column:
    """Whether the key is there.  A value with a text is; only a JSON null has
    none, and is told from a missing key by its variant."""
    return F.when(F.col(field).isNotNull(), F.lit(True)).otherwise(_value(field).isNotNull())


def _checks(variant: str) -> list[tuple[str, Column]]:
    """Ordered (reason, keep-condition) over the staged columns ``v`` (the
    parsed line) and the texts of the fields; a field is present when its
    variant is not SQL NULL (a JSON null is a variant null, which is present)."""
    checks = [
        ("bad_json", F.col("v").isNotNull()),
        ("no_target", _present("target_id")),
        ("no_actor", _present("actor_id")),
    ]
    if variant == "B":
        checks.append(("no_username", _present("actor_name") & _present("target_name")))
    checks += [
        ("falsy_target", _truthy(F.col("target_id"), _value("target_id"))),
        ("no_message", _present("message")),
        ("no_time", _present("time_sended")),
    ]
    return checks


def parse_payments(lines: DataFrame, variant: str = "B", extra: dict[str, str] | None = None,
                   keep_rejects: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """``(payments, rejects)``.

    ``payments`` has the PAYMENT columns plus ``file_path``, ``doc_id`` and
    any ``extra`` name -> JSON path.  ``rejects`` has ``(value, file_path,
    reason)``.  Each line is parsed once; the record is cast once into a
    struct of sub-variants (top level, actor, first target) and every rule
    and field reads those.
    """
    good, bad = split_records(parse_records(lines, variant, extra))
    return good, bad if keep_rejects else None


def split_records(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The accepted and the rejected ones."""
    good = records.filter(F.col("reason").isNull()).select(
        *[F.col("parsed").alias(n) if n == "time_sended" else n for n in records.columns if n not in ("value", "reason", "parsed")])
    bad = records.filter(F.col("reason").isNotNull()).select("value", "file_path", "reason")
    return good, bad


@contextmanager
def parsed_once(records: DataFrame) -> Iterator[tuple[DataFrame, DataFrame]]:
    """``split_records`` of lines that are read and parsed once for both: of a
    line either its fields or its text is kept until the end."""
    ok = F.col("reason").isNull()
    slim = records.select(*[n if n in ("file_path", "reason") else F.when(~ok if n == "value" else ok, F.col(n)).alias(n)
                            for n in records.columns])
    with written(slim, "records") as kept:
        yield split_records(kept)


def parse_records(lines: DataFrame, variant: str = "B", extra: dict[str, str] | None = None) -> DataFrame:
    """Every line with its fields, and the ``reason`` if it is rejected."""
    if variant not in ("A", "B"):
        raise ValueError("variant is 'A' (four fields) or 'B' (six fields)")
    # the texts are taken out of the parsed line at once; a sub-variant, which
    # is a copy, is made only of a field that has no text
    staged = lines.select("value", "file_path", F.try_parse_json(F.col("value")).alias("v"))
    staged = staged.select("value", "file_path", "v", F.try_variant_get("v", "$", _TEXTS).alias("r"))
    party = F.get(F.col("r.transactions"), F.lit(0))["target"]
    staged = staged.select("value", "file_path", "v", F.col("r.actor.id").alias("actor_id"),
                           F.col("r.actor.username").alias("actor_name"), party["id"].alias("target_id"),
                           party["username"].alias("target_name"), "r.message", F.col("r.updated_time").alias("time_sended"))
    reason = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name))
                          for name, ok in _checks(variant)])
    unnamed = () if variant == "B" else ("actor_name", "target_name")
    named = [(n, F.lit(None).cast("string") if n in unnamed else F.col(n)) for n in _PATHS]  # the time is parsed after the fence
    named += [
        ("file_path", F.col("file_path")),
        # content hash of the source line: stable across reruns; the ordinal
        # that tells identical lines of a file apart is added when they are stored
        ("doc_id", F.sha2(F.concat_ws("\n", "file_path", "value"), 256).substr(1, 32)),
    ]
    named += [(n, F.try_variant_get(F.col("v"), p, "string")) for n, p in (extra or {}).items()]
    names_out = [n for n, _ in named]
    # One-element generator as a fence: filters on its output cannot be
    # pushed beneath it, so every line is parsed once, not once per check.
    rec = staged.select(F.inline(F.array(F.struct(
        F.col("value"), reason.alias("reason"), *[c.alias(n) for n, c in named]))))
    # the time is parsed from the fenced text column, so its field cuts read
    # an attribute instead of re-running the variant extraction; a second
    # fence keeps the parse from being run again by the filter on it
    rec = rec.select("value", "reason", *names_out, F.inline(F.array(F.struct(
        parse_iso_time("time_sended").alias("parsed")))))
    unread = F.col("parsed").isNull() & F.col("time_sended").isNotNull()
    return rec.withColumn("reason", F.coalesce("reason", F.when(unread, F.lit("bad_time"))))


def with_index_columns(payments: DataFrame, variant: str = "B", grain: str = "day") -> DataFrame:
    """Columns stored with every payment: analysed tokens (X1/X3; X2 for the
    four-field index) and the partition column for pruning time ranges, named
    after its grain (``day`` or ``month``: a partition should hold enough rows
    for a file)."""
    return _with_tokens(_dated(payments, grain), variant, grain)


def _dated(payments: DataFrame, grain: str) -> DataFrame:
    return payments.withColumn(grain, F.to_date(F.date_trunc(grain, "time_sended")))


def _with_tokens(dated: DataFrame, variant: str, grain: str) -> DataFrame:
    tokens = analyze("message") if variant == "B" else analyze_standard("message")
    rest = [c for c in dated.columns if c not in (grain, "tokens")]
    return dated.select(*rest, tokens.alias("tokens"), grain)


def load_key(path: str, path_glob_filter: str | None = None) -> str:
    """The load that the files of a path belong to."""
    return hashlib.md5(f"{path}|{path_glob_filter or ''}".encode()).hexdigest()[:16]


def ensure_table(spark: SparkSession, name: str, location: str, grain: str = "day") -> None:
    """Create the payments table if absent (schema, layout, partitioning)."""
    spark.sql(f"""
        CREATE TABLE IF NOT EXISTS {name} (
          actor_id STRING, actor_name STRING, target_id STRING, target_name STRING,
          message STRING, time_sended TIMESTAMP_NTZ, file_path STRING, doc_id STRING,
          tokens ARRAY<STRING>, load STRING, {grain} DATE)
        USING parquet PARTITIONED BY (load, {grain}) LOCATION '{location}'""")


def sync_table(spark: SparkSession, name: str, location: str) -> None:
    """The table's partitions become those of the live folders."""
    ledger = L.Ledger(spark, location)
    alive = {f.name for f in ledger.live()}
    held = {r.partition for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    want = {f"load={n}/{d}" for n in alive for d in L.children(spark, ledger.data(n)) if "=" in d}

    def spec(p: str) -> str:
        return "PARTITION (" + ", ".join("{}='{}'".format(*x.split("=", 1)) for x in p.split("/")) + ")"

    for p in sorted(held - want):
        spark.sql(f"ALTER TABLE {name} DROP {spec(p)}")
    if want - held:
        spark.sql(f"ALTER TABLE {name} ADD " + " ".join(spec(p) for p in sorted(want - held)))
    spark.catalog.refreshTable(name)


def _numbered(payments: DataFrame, grain: str) -> DataFrame:
    """Dealt by (day, document), with equal lines of a file told apart."""
    # range partitioning on (day, doc_id): few days per task (few files), a hot
    # day is split across tasks, and identical lines meet, so that numbering
    # them needs no further shuffle; a hash is of one line of one file, so a
    # group is at most the repeats of a line inside a file
    dealt = payments.repartitionByRange(grain, "doc_id")
    n = F.row_number().over(Window.partitionBy(grain, "doc_id").orderBy("doc_id")) - 1
    doc_id = F.when(F.col("_n") == 0, F.col("doc_id")).otherwise(F.concat_ws("-", "doc_id", "_n"))
    return dealt.withColumn("_n", n).withColumn("doc_id", doc_id).drop("_n")


def _write(rows: DataFrame, path: str, grain: str, max_records_per_file: int) -> None:
    (rows.write.mode("overwrite").partitionBy(grain).option("maxRecordsPerFile", max_records_per_file)
     .option("compression", "zstd").parquet(path))


#: Partial aggregates of a folder, by kind: they add up over folders.
AGGREGATES = {"edges": "source string, target string, weight bigint", "terms": "token string, df bigint, tf bigint",
              "field": "n_docs bigint, length bigint"}


def _aggregate(rows: DataFrame, ledger: L.Ledger, name: str) -> None:
    a, t = F.col("actor_id"), F.col("target_id")
    edges = rows.groupBy(F.least(a, t).alias("source"), F.greatest(a, t).alias("target")).agg(F.count("*").alias("weight"))
    once = rows.select(F.explode(F.array_distinct("tokens")).alias("token"), F.lit(1).alias("df"), F.lit(0).alias("tf"))
    each = rows.select(F.explode("tokens").alias("token"), F.lit(0).alias("df"), F.lit(1).alias("tf"))
    terms = once.unionByName(each).groupBy("token").agg(F.sum("df").alias("df"), F.sum("tf").alias("tf"))
    field = rows.filter(F.size("tokens") > 0).agg(F.count("*").alias("n_docs"),
                                                  F.coalesce(F.sum(F.size("tokens").cast("bigint")), F.lit(0)).alias("length"))
    for kind, df in (("edges", edges), ("terms", terms), ("field", field)):
        df.write.mode("overwrite").parquet(ledger.aggregate(kind, name))


def write_payments(payments: DataFrame, location: str, load: str, variant: str = "B", grain: str = "day",
                   max_records_per_file: int = 5_000_000, files: DataFrame | None = None, name: str | None = None,
                   removes: list[str] | None = None, aggregates: bool = False, made: bool = False) -> None:
    """Writes one folder and makes it live.  It replaces the folders
    ``removes`` names (default: those that an earlier run stored under the same
    ``load``); all others stay.  ``files`` are its source files.  Payments that
    are read from a table (``made``) are not written down before they are dealt."""
    spark = payments.sparkSession
    ledger = L.Ledger(spark, location)
    removes = [f.name for f in ledger.live() if f.load == load] if removes is None else removes
    name = ledger.fresh(name or load)
    # made once: dealing by ranges reads its rows twice
    with nullcontext(payments) if made else written(payments, "payments") as rows, shuffles_deleted(spark):
        # analysed where they come to lie: what moves are the payments
        _write(_with_tokens(_numbered(_dated(rows, grain), grain), variant, grain), ledger.data(name), grain, max_records_per_file)
    if aggregates:
        with shuffles_deleted(spark):
            _aggregate(spark.read.parquet(ledger.data(name)), ledger, name)
    ledger.commit(name, load, spark.createDataFrame([], L.FILES) if files is None else files, removes)


def write_rejects(rejects: DataFrame, location: str, load: str) -> None:
    """The rejected lines of one folder, replaced with it."""
    rejects.write.mode("overwrite").option("compression", "gzip").json(f"{location.rstrip('/')}/load={load}")


def store(records: DataFrame, location: str, load: str, variant: str, grain: str, rejects_location: str | None, name: str, **kw) -> None:
    """Writes one folder of parsed lines, and the rejected ones if asked."""
    if rejects_location is None:
        write_payments(split_records(records)[0], location, load, variant, grain, name=name, **kw)
        return
    with parsed_once(records) as (good, bad):
        write_rejects(bad, rejects_location, name)
        write_payments(good, location, load, variant, grain, name=name, made=True, **kw)


def read_index(spark: SparkSession, location: str) -> DataFrame:
    """The stored payments of all live folders (lazy; partition-pruned by
    ``day`` filters)."""
    ledger = L.Ledger(spark, location)
    rows = ledger.read() if ledger.exists() else spark.read.parquet(location)
    if rows is None:
        return spark.createDataFrame([], "actor_id string, actor_name string, target_id string, target_name string, "
                                         "message string, time_sended timestamp_ntz, file_path string, doc_id string, "
                                         "tokens array<string>, day date")
    return rows.drop("load")


def _without(spark: SparkSession, ledger: L.Ledger, gone: DataFrame, grain: str, aggregates: bool) -> None:
    """Rewrites the folders that hold files of ``gone`` (file, name) without
    those files: each as a new folder that replaces the old one."""
    live = {f.name: f for f in ledger.live()}
    for r in gone.select("name").distinct().collect():
        old = live[r.name]
        files = gone.filter(F.col("name") == old.name).select("file")
        rows = ledger.read([old]).join(files.withColumnRenamed("file", "file_path"), "file_path", "left_anti").drop("load")
        kept = ledger.files([old]).join(files, "file", "left_anti")
        name = ledger.fresh(f"{old.load}-{L.digest(old.name, sorted(f.file for f in files.collect()))}")
        _write(rows, ledger.data(name), grain, 5_000_000)
        if aggregates:
            _aggregate(spark.read.schema(rows.schema).parquet(ledger.data(name)), ledger, name)
        ledger.commit(name, old.load, kept, [old.name])


def ingest(spark: SparkSession, path: str, location: str, variant: str = "B",
           path_glob_filter: str | None = None, rejects_location: str | None = None,
           load: str | None = None, grain: str = "day", aggregates: bool = False) -> int:
    """S1 -> P1/P2 -> S3 (plus the rejects if asked) for the files that are not
    stored yet; returns their number.

    A file that is stored as it is now (path, size and time) is not read
    again.  One that has changed is stored anew and taken out of the folder
    that held it.  The folders are named after the path unless the caller
    names the load."""
    ledger = L.Ledger(spark, location)
    load = load or load_key(path, path_glob_filter)
    held = ledger.files()
    found = L.listing(spark, path, path_glob_filter)
    new = found.join(held, ["file", "size", "time"], "left_anti").collect()  # the listing is the driver's already
    if not new:
        return 0
    files = spark.createDataFrame([(r.file, r.size, r.time) for r in new], L.FILES)
    changed = held.join(files.select("file"), "file", "left_semi").select("file", "name").collect()
    name = f"{load}-{L.digest(sorted((r.file, r.size, r.time) for r in new))}"
    lines = read_lines(spark, [L.literal(r.path) for r in new])
    records = parse_records(lines, variant)
    if changed:
        _without(spark, ledger, spark.createDataFrame(changed, "file string, name string"), grain, aggregates)
    store(records, location, load, variant, grain, rejects_location, files=files, name=name, removes=[], aggregates=aggregates)
    return len(new)


def compact(spark: SparkSession, location: str, smaller_than: int | None = 1 << 30, grain: str = "day",
            max_records_per_file: int = 5_000_000) -> list[str]:
    """Merges the live folders of fewer bytes (None: all) into one, which replaces
    them in one step; returns their names.  Their aggregates are added up as well."""
    ledger = L.Ledger(spark, location)
    small = [f for f in ledger.live() if smaller_than is None or f.bytes < smaller_than]
    if len(small) < 2:
        return []
    name = ledger.fresh(f"merged-{L.digest([f.name for f in small])}")
    rows = ledger.read(small).drop("load")
    with shuffles_deleted(spark):
        _write(rows.repartitionByRange(grain, "doc_id"), ledger.data(name), grain, max_records_per_file)
        for kind, schema in AGGREGATES.items():
            parts = [ledger.aggregate(kind, f.name) for f in small]
            if all(L.exists(spark, p) for p in parts):
                _summed(spark.read.schema(schema).parquet(*parts), kind).write.mode("overwrite").parquet(ledger.aggregate(kind, name))
    ledger.commit(name, "merged", ledger.files(small), [f.name for f in small])
    return [f.name for f in small]


def _summed(parts: DataFrame, kind: str) -> DataFrame:
    keys = {"edges": ["source", "target"], "terms": ["token"], "field": []}[kind]
    return parts.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in parts.columns if c not in keys])


def stored_edges(spark: SparkSession, location: str) -> DataFrame:
    """A1 from the folders' aggregates: ``(source, target, weight)``.  (For
    A3: ``topic_graph.degrees``.)"""
    return _summed(L.Ledger(spark, location).aggregates("edges", AGGREGATES["edges"]), "edges")


def stored_terms(spark: SparkSession, location: str) -> DataFrame:
    """A14 from the folders' aggregates: ``(token, df, tf)``; documents lie in
    one folder each, so their frequencies add up."""
    return _summed(L.Ledger(spark, location).aggregates("terms", AGGREGATES["terms"]), "terms")


def stored_field_stats(spark: SparkSession, location: str) -> DataFrame:
    """``(n_docs, avgdl)`` over documents with at least one term."""
    s = _summed(L.Ledger(spark, location).aggregates("field", AGGREGATES["field"]), "field")
    return s.select("n_docs", F.try_divide("length", "n_docs").alias("avgdl"))

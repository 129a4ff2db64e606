"""The registered queries: each operator, with its production parameters,
over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import table
from . import (block_naming, collocations, decontamination, divergence, license_notices, line_templates, main_text,
               mixing, secret_scan, simhash, suffix_tree, toxicity, warc)
from .oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

#: Shares of the domains, and of the languages in one of them; what is not
#: named shares the rest alike.
MIX_WEIGHTS = {("domain0",): 0.4, ("domain1",): 0.3, ("domain2",): 0.2, ("domain0", "en"): 0.5}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def domain():
    """The domain of a source: four groups by the number in its name."""
    return F.concat(F.lit("domain"), F.expr(r"try_cast(regexp_extract(source, '([0-9]+)$', 1) AS bigint) % 4").cast("string"))


@register("op1_decontamination")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    found = decontamination.find(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


@register("op2_simhash_near_dedup")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_dedup(table(spark, sf, "documents"))


@register("op3_line_dedup")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return line_templates.summary(table(spark, sf, "documents"))


@register("op4_toxicity")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    held_out = toxicity.held_out(F.col("doc_id"))
    model = toxicity.fit(docs, table(spark, sf, "labels"), learn=~held_out)
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted"),
        F.size("toxicity.evidence").alias("n_neighbours"),
        F.col("toxicity.evidence.doc_id").alias("nearest"))


@register("op5_warc")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    archives = warc.write_archives(table(spark, sf, "pages"), scratch_path(spark, "warc"))
    return warc.counted(archives, warc.read_archives(archives, payloads=False)).select(
        F.col("page_id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"))


@register("op6_exact_dedup")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return block_naming.exact_dedup(table(spark, sf, "documents"))


@register("op7_secret_scan")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return secret_scan.report(secret_scan.scan(docs, repository=F.concat_ws("/", "source", "lang")))


@register("op8_main_text")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return main_text.extract(table(spark, sf, "pages"))


@register("op9_suffix_tree_lm")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_tree.train_and_score(table(spark, sf, "documents"))


@register("op10_mixing")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source").withColumn("domain", domain())
    return mixing.mix(docs, weights=MIX_WEIGHTS).select("doc_id", "domain", "lang", "source", "n_tokens", "epoch")


@register("op11_license_scan")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return license_notices.report(license_notices.scan(table(spark, sf, "documents")))


@register("op12_collocations")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.mine(table(spark, sf, "documents"))


@register("op13_source_divergence")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audit(table(spark, sf, "documents"))

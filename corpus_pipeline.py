"""The corpus pipeline: toxicity, line dedup, SimHash near-dedup, benchmark
decontamination, mixing to target weights.

``STAGES`` lists the stages; each takes ``(spark, docs, sf_dir)`` and returns
a DataFrame.  ``run`` applies them to the table ``documents``, writing each
stage's result to the shared scratch folder and reading it again.

Defined results: nulls, empty texts, repeated rows and empty tables go through
every stage as its operator states; all stages but the last return the columns
of their input, the last adds ``n_tokens`` and ``epoch``.  A changed text gets
its ``n_chars`` anew (where the input has that column).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicgraph.llm import decontamination, line_templates, mixing, simhash, toxicity
from topicgraph.llm.common import SPACE, free_name, written
from topicgraph.llm.queries import MIX_WEIGHTS, domain
from topicgraph.session import ensure_checkpoint_dir
from topicgraph.sources.tables import table


def recounted(docs: DataFrame, before: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now, in the type it had."""
    if "n_chars" not in before.columns:
        return docs
    n = F.length("text").cast(before.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(n)).select(*before.columns)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, learn=~toxicity.held_out(F.col("doc_id")))
    return toxicity.reject(docs, model)


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go; so do documents that lose all their words."""
    lost = free_name(docs, "n_dropped")
    out = line_templates.drop_templates(docs, lost=lost)
    empty = F.regexp_replace(F.coalesce("text", F.lit("")), SPACE + "+", "") == ""
    return recounted(out.filter((F.col(lost) == 0) | ~empty), docs)


def one_of_each_near_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: the one with the smallest id."""
    return simhash.one_of_each(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out of the texts."""
    return recounted(decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark")), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents selected by token budgets of domains, languages and sources."""
    name = free_name(docs, "domain")
    tree = [name, "lang", "source"]
    return mixing.mix(docs.withColumn(name, domain()), tree, MIX_WEIGHTS).drop(name)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_recurring_lines),
    ("simhash_near_dedup", one_of_each_near_copy),
    ("decontamination", remove_benchmark),
    ("mixing", mix_sources),
]

#: The nearest examples and the FM-index are beyond SQL; the stages are
#: tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

"""Exact dedup by deterministic block naming (Karp, Miller and Rosenberg).

Each text is cut into blocks of a fixed number of characters.  The distinct
blocks of the corpus are sorted and get integer names; then, round by round,
the distinct pairs of adjacent names are sorted and named, until one name is
left for each document.  Equal texts, and only those, end with the same
(number of blocks, name): there is no hash in the identity.

How it runs.  The text is shuffled once, after map-side combination, to find
the distinct blocks.  Rows find the name of their block by the block's
digest, and the job first proves on the named blocks that no digest stands
for two of them (else it takes another digest and names again), so the names
are free of collisions and a second shuffle of the text is not needed.
Later rounds move integers only, for the documents that still have several
names: log2 of the longest document's blocks in all.  A block, pair or
identity that a third of the rows share is combined before each shuffle; the
joins that hand names back are plain equi-joins, whose large partitions
Spark splits.  Every round is written to the shared scratch folder.

Defined results: a null text counts as empty; the empty text has one (empty)
block.  Rows with equal id and equal text are one group with both rows; of
these the first row read stays.  A null id sorts after all others, and
``keep_id`` is null only where the whole group has null ids.  Extra columns
are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbering import numbered
from .common import SPACE, written

#: Characters in a block.
BLOCK = 2048


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space; null becomes ''."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE + "+", " ")


def digest(block: Column, salt: int) -> Column:
    return F.unhex(F.sha2(F.concat(F.lit(f"{salt}:"), block).cast("binary"), 256))


def _blocks(text: Column, size: int) -> Column:
    """The text in pieces of ``size`` characters, found in one pass."""
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return F.when(F.length(text) > 0, cut).otherwise(F.array(F.lit("")))


def _named(values: DataFrame, *by: str) -> DataFrame:
    """The distinct rows with ``name``: their place in the order of ``by``,
    so that names do not depend on partitions."""
    return numbered(values.distinct(), list(by), "name")


def _block_names(texts: DataFrame, size: int, key: Callable[[Column, int], Column]) -> tuple[DataFrame, int]:
    """``(key, name)`` of the distinct blocks, and the salt under which no
    key stands for two blocks.  Blocks are sorted by their keys: 32 bytes, not
    the block, move for it."""
    for salt in range(64):
        blocks = texts.select(F.explode(_blocks(F.col("text"), size)).alias("block"))
        blocks = blocks.select(key(F.col("block"), salt).alias("key"), "block")
        keys = written(blocks.distinct().select("key"), "block-keys")
        if keys.groupBy("key").count().filter("count > 1").isEmpty():
            return written(_named(keys, "key"), "block-names"), salt
    raise RuntimeError("no digest separates the blocks")


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = BLOCK,
               key: Callable[[Column, int], Column] = digest) -> DataFrame:
    """``(row, doc_id, text_sha256, n_blocks, name)``, one row per document;
    (n_blocks, name) are equal for equal normalised texts only."""
    texts = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("text"))
    names, salt = _block_names(texts, size, key)
    rows = written(texts.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
        F.transform(_blocks(F.col("text"), size), lambda b: key(b, salt)).alias("keys")), "block-rows")
    placed = rows.select("row", F.posexplode("keys").alias("pos", "key"))
    seq = written(placed.join(names, "key").select("row", "pos", "name"), "block-places")
    done = None
    while True:
        # a document's number of names halves each round; those with one are finished
        left = seq.groupBy("row").agg(F.count("*").alias("k"), F.min("name").alias("name"))
        ready = left.filter("k = 1").select("row", "name")
        done = ready if done is None else done.unionByName(ready)
        more = seq.join(left.filter("k > 1").select("row"), "row", "left_semi")
        pairs = more.groupBy("row", F.expr("pos div 2").cast("int").alias("pos")).agg(
            F.max(F.expr("CASE WHEN pos % 2 = 0 THEN name END")).alias("a"),
            F.coalesce(F.max(F.expr("CASE WHEN pos % 2 = 1 THEN name END")), F.lit(-1)).alias("b"))
        pairs = written(pairs, "pairs")
        if pairs.isEmpty():
            break
        names = written(_named(pairs.select("a", "b"), "a", "b"), "pair-names")
        seq = written(pairs.join(names, ["a", "b"]).select("row", "pos", "name"), "places")
    # one identity per row: the round in which a document ends follows from n_blocks
    return (rows.join(done, "row")
            .select("row", "doc_id", "text_sha256", F.size("keys").alias("n_blocks"), "name"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = BLOCK,
                key: Callable[[Column, int], Column] = digest) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per
    document: of equal texts the row with the smallest id stays."""
    ids = written(identities(docs, id_col, text_col, size, key), "identities")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    groups = ids.groupBy("n_blocks", "name").agg(first.alias("first"), F.count("*").alias("group_size"))
    return _told(ids, written(groups, "groups"))


def _told(ids: DataFrame, groups: DataFrame) -> DataFrame:
    """Every document with its group: two written tables, so that Spark splits
    the partition of a large group."""
    return (ids.join(groups, ["n_blocks", "name"])
            .select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
                    (F.col("first.row") == F.col("row")).alias("kept"), "text_sha256"))

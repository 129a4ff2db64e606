"""SimHash near-dedup through deletion-variant signatures.

A document's fingerprint has 64 bits, each the majority over the XXH64 of its
word shingles.  Two fingerprints link when they differ in at most ``k`` bits.
The 64 bits are cut into s = k // 2 + 1 segments; as 2 s > k, one segment of
a linked pair differs in at most one bit.  So every distinct fingerprint is
indexed under 64 signatures: one of its segments with one bit blanked.
Linked pairs meet in the bucket of an equal signature (equality of integers),
where the whole distance is verified.

No bucket emits its pairs.  A bucket's members lie sorted in one stream; its
links are walked from the smallest member outwards, and one edge is kept for
each member reached, so a bucket of m gives less than m edges and loses no
connection.  A bucket with more than ``bucket`` members is cut again by
the exact value of one of k + 1 pieces of its other bits (two linked
fingerprints agree in one piece), as often as needed; as each cut fixes more
bits, a bucket ends within the bound.

Equal fingerprints are one node whatever their number, with the smallest
document id; the component search moves fingerprints only.  Rows with null
or empty text have fingerprint zero, linked like any other.  Repeated rows
stay as rows.  ``component_id`` is null only where every id reached is null.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.components import connected_components
from .common import free_name, written

#: Words of a shingle, and the most differing bits of a link.
SHINGLE, BITS = 4, 4
#: Members that one bucket may hold in a task.
BUCKET = 50_000
SEED = 42


def text_fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit fingerprint of one text, as a signed integer."""
    import numpy as np
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    h64, step = xxhash.xxh64_intdigest, 1 << 16
    ones, n = np.zeros(64, np.int64), len(words) - width + 1
    for i in range(0, n, step):
        j = min(n, i + step)
        spans = zip(starts[i:j].tolist(), ends[i + width - 1:j + width - 1].tolist())
        h = np.fromiter((h64(joined[a:b], seed) for a, b in spans), np.uint64, j - i)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * ones > n).astype(np.uint8), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)`` with the fingerprint as a signed 64-bit integer."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            fps = [text_fingerprint(t.as_py(), shingle) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([narrow.schema["doc_id"], T.StructField("fp", T.LongType())])
    return narrow.mapInArrow(run, schema)


def _segments(k: int) -> list[int]:
    """Bit masks of the k // 2 + 1 segments."""
    s = k // 2 + 1
    cuts = [64 * i // s for i in range(s + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _signatures(fps: DataFrame, k: int) -> DataFrame:
    """``(sig, key, fixed, fp)``: under signature ``sig`` (the blanked bit),
    ``key`` is the rest of its segment; ``fixed`` marks the bits in use."""
    masks = [m for m in _segments(k) for _ in range(bin(m).count("1"))]
    table = F.array(*[F.lit(_signed(m & ~(1 << i))) for i, m in enumerate(masks)])
    spread = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("sig"))
    fixed = F.element_at(table, F.col("sig") + 1)
    whole = F.element_at(F.array(*[F.lit(_signed(m)) for m in masks]), F.col("sig") + 1)
    return spread.select("sig", F.col("fp").bitwiseAND(fixed).alias("key"), whole.alias("fixed"), "fp")


def _refined(rows: DataFrame, k: int) -> DataFrame:
    """Rows of large buckets under k + 1 finer keys each: one piece of the
    bits not yet fixed joins the key."""
    def pieces(fixed: int) -> list[int]:
        free = [i for i in range(64) if not fixed >> i & 1]
        cuts = [len(free) * j // (k + 1) for j in range(k + 2)]
        return [sum(1 << i for i in free[a:b]) for a, b in zip(cuts, cuts[1:])]

    @F.udf("array<bigint>")
    def cut(fixed):
        return [_signed(p) for p in pieces(fixed & (1 << 64) - 1) if p]

    shapes = rows.select("fixed").distinct().withColumn("piece", F.explode(cut("fixed")))
    fine = rows.join(shapes, "fixed")
    return fine.select(
        # the bucket's name grows by the piece; equal names have equal fixed bits
        F.xxhash64("sig", "piece", "fixed").alias("sig"),
        F.col("key").bitwiseXOR(F.col("fp").bitwiseAND(F.col("piece"))).alias("key"),
        F.col("fixed").bitwiseOR(F.col("piece")).alias("fixed"), "fp")


def _walk(fp, k: int):
    """Edges that connect the members of one bucket as all links within
    ``k`` bits do: walk out from the smallest member not yet reached."""
    import numpy as np

    left = np.sort(fp)
    a, b = [], []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(left ^ at) <= k
            if near.any():
                found = left[near]
                a.append(np.full(len(found), at)), b.append(found)
                queue.extend(found)
                left = left[~near]
    return a, b


def _bucket_edges(rows: DataFrame, k: int, n: int) -> DataFrame:
    """Verified edges ``(source, target)`` of all buckets; a bucket's rows
    come one after another, sorted."""
    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        def emit(a, b):
            a, b = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (a, b))
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], ["source", "target"])

        held = None
        for batch in batches:
            sig, key, fp = (np.asarray(batch.column(i)) for i in range(3))
            if held is not None:
                sig, key, fp = (np.concatenate(x) for x in zip(held, (sig, key, fp)))
            cut = np.flatnonzero((sig[1:] != sig[:-1]) | (key[1:] != key[:-1])) + 1
            if not len(cut):
                held = sig, key, fp
                continue
            last = cut[-1]
            held = sig[last:], key[last:], fp[last:]
            yield emit(*run_edges(np.concatenate(([0], cut)), fp[:last].view(np.uint64)))
        if held is not None:
            yield emit(*run_edges(np.array([0, len(held[2])]), held[2].view(np.uint64)))

    def run_edges(bounds, fp):
        import numpy as np

        size = np.diff(bounds)
        at = bounds[:-1][size == 2]
        x, y = fp[at], fp[at + 1]
        near = np.bitwise_count(x ^ y) <= k
        a, b = [x[near]], [y[near]]
        for i in np.flatnonzero(size > 2):
            p, q = _walk(fp[bounds[i]:bounds[i + 1]], k)
            a += p
            b += q
        return a, b

    dealt = rows.repartition(n, "sig", "key").sortWithinPartitions("sig", "key", "fp")
    return dealt.select("sig", "key", "fp").mapInArrow(run, "source bigint, target bigint").distinct()


def links(fps: DataFrame, k: int = BITS, bucket: int = BUCKET) -> DataFrame:
    """Edges among distinct fingerprints (column ``fp``) with the same
    components as all links within ``k`` bits."""
    rows = _signatures(fps, k).select(F.col("sig").cast("bigint").alias("sig"), "key", "fixed", "fp")
    n = max(8, int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    edges = None
    while True:
        large = written(rows.groupBy("sig", "key").agg(F.count("*").alias("m"))
                        .filter(F.col("m") > bucket).select("sig", "key"), "large-buckets")
        if large.isEmpty():
            part = _bucket_edges(rows, k, n)
            return part if edges is None else edges.unionByName(part).distinct()
        part = written(_bucket_edges(rows.join(large, ["sig", "key"], "left_anti"), k, n), "bucket-edges")
        edges = part if edges is None else edges.unionByName(part)
        rows = written(_refined(rows.join(large, ["sig", "key"], "left_semi"), k), "finer-buckets")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
               k: int = BITS, bucket: int = BUCKET) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per document;
    ``component_id`` is the smallest id reachable over links."""
    ids = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = written(ids.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    comp = components(nodes, k, bucket)
    return (ids.join(comp, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def components(nodes: DataFrame, k: int = BITS, bucket: int = BUCKET) -> DataFrame:
    """``(fp, component_id)`` for distinct fingerprints with ``first``, the
    smallest id of each."""
    edges = links(nodes.select("fp"), k, bucket)
    comp = connected_components(nodes.select(F.col("fp").alias("id")), edges)
    named = comp.join(nodes, comp["id"] == nodes["fp"]).select("fp", "component", "first")
    named = written(named, "components")
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    return _told(named, written(least, "least-ids"))


def _told(named: DataFrame, least: DataFrame) -> DataFrame:
    """Every fingerprint with its component's id: two written tables, so that
    Spark splits the partition of a large component."""
    return named.join(least, "component").select("fp", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                k: int = BITS) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest
    id (nulls last), and among equal ids the first row read."""
    row = free_name(docs, "row")
    kept = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    # the fingerprint pass carries (id, row number); its order is that of the ids, nulls last
    tagged = kept.select(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"),
                                  F.col(row).alias("row")).alias("at"), F.col(text_col).alias("text"))
    ids = written(fingerprints(tagged, "at", "text", shingle), "fingerprints")
    nodes = written(ids.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    keep = components(nodes, k).select(F.col("component_id.row").alias(row)).distinct()
    return kept.join(keep, row, "left_semi").drop(row)

"""Mixing sources to target weights by hierarchical budgeting.

Sources are the leaves of a tree (domain, language, source by default).  A
node's weight is its share among its siblings; siblings without a given
weight share alike what the given ones leave.  The token budget of the root is handed down: each node gives
its budget to its children by weight, but no child gets more than all leaves
below it can supply (``max_epochs`` times their tokens), and what a child
cannot take goes to its siblings by their weights.  So a shortage is made up
among siblings first, and reaches an ancestor's level only when a whole
subtree is short.

A leaf reads its documents in seeded epochs: each epoch is an order of its
own (a hash of seed, epoch and document), full epochs are taken whole, and of
the last one the longest prefix that fits the budget is selected.

All of it is DataFrame functions.  The tree is an aggregate; filling a level
is a running sum over siblings, sorted by supply per weight.  A prefix of a
leaf that holds a third of all rows is found without sorting the leaf: rows
fall by their hash into ``BINS`` bins, the bins' token sums (combined before
the shuffle) tell in which bin the prefix ends, all earlier bins are taken
whole, and only the rows of that one bin are put in order.

Defined results: a null text has no tokens.  Documents without tokens cost
nothing and are taken where their place in the order is in the prefix.  A
null in a tree column is a branch of its own.  Equal rows are interchangeable;
rows of one id are ordered by a hash of their text.  A leaf without supply
gets nothing; a weight of zero or less means no budget.  An empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import SPACE, free_name, written

#: Epochs at most, bins of an order, seed, and the share of all tokens that
#: makes the default budget.
MAX_EPOCHS, BINS, SEED, SHARE = 4, 4096, 17, 0.5
TREE = ("domain", "lang", "source")


def n_tokens(text: Column) -> Column:
    """Words between ASCII white space; null has none."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{SPACE}+|{SPACE}+$", "")
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, SPACE + "+"))).cast("bigint")


def text_hash(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def order_key(seed: int, epoch: Column, doc_id: Column, text: Column) -> Column:
    """Place of a document in an epoch: 60 bits of a hash of its id and the
    hash of its text."""
    said = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id, F.lit("")), text)
    return F.conv(F.substring(F.md5(said.cast("binary")), 1, 15), 16, 10).cast("bigint")


def _meet(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null meets null; the columns ``on`` come once."""
    other = right.select(*[F.col(c).alias(f"_on{i}") for i, c in enumerate(on)],
                         *[c for c in right.columns if c not in on])
    same = [F.col(c).eqNullSafe(F.col(f"_on{i}")) for i, c in enumerate(on)]
    return left.join(other, same, how).drop(*[f"_on{i}" for i in range(len(on))])


def _fill(children: DataFrame, on: list[str]) -> DataFrame:
    """Budgets of children ``(.., weight, supply, total)``: ``total`` is the
    parent's budget, handed out by weight below the supplies."""
    rate = F.when(F.col("weight") > 0, F.col("supply") / F.col("weight"))
    c = children.withColumn("rate", rate)
    w = Window.partitionBy(*on).orderBy(F.col("rate").asc_nulls_first(), *[F.col(x) for x in sorted(
        x for x in children.columns if x not in ("weight", "supply", "total"))])
    upto, rest = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(1, Window.unboundedFollowing)
    supply = F.when(F.col("weight") > 0, F.col("supply")).otherwise(0.0)
    c = c.withColumn("_taken", F.sum(supply).over(upto)).withColumn(
        "_open", F.coalesce(F.sum(F.greatest(F.col("weight"), F.lit(0.0))).over(rest), F.lit(0.0)))
    # a child is full if the budget covers all fuller ones and this rate for the others
    full = (F.col("rate").isNotNull()) & (F.col("_taken") + F.col("rate") * F.col("_open") <= F.col("total") + 1e-9)
    c = c.withColumn("_full", full)
    every = Window.partitionBy(*on)
    used = F.sum(F.when(F.col("_full"), F.col("supply")).otherwise(0.0)).over(every)
    open_ = F.sum(F.when(~F.col("_full") & (F.col("weight") > 0), F.col("weight")).otherwise(0.0)).over(every)
    c = c.withColumn("_used", used).withColumn("_weight", open_)
    budget = (F.when(F.col("rate").isNull(), 0.0).when(F.col("_full"), F.col("supply"))
              .otherwise((F.col("total") - F.col("_used")) * F.col("weight") / F.col("_weight")))
    return c.withColumn("budget", budget).drop("rate", "_taken", "_open", "_full", "_used", "_weight", "total")


def _weights(nodes: DataFrame, path: list[str], weights: dict[tuple, float] | None) -> DataFrame:
    """``nodes`` with ``weight``: the given one, or an equal part of what the
    given weights of the siblings leave (none left: 0)."""
    given = {k: v for k, v in (weights or {}).items() if len(k) == len(path)}
    if not given:
        return nodes.withColumn("weight", F.lit(1.0))
    kinds = StructType([nodes.schema[c] for c in path])
    table = nodes.sparkSession.createDataFrame(
        [(*k, float(v)) for k, v in given.items()], StructType([*kinds, *StructType().add("given", "double")]))
    met = _meet(nodes, table, path, "left")
    siblings = Window.partitionBy(*path[:-1]) if path[:-1] else Window.partitionBy(F.lit(0))
    left = F.greatest(1 - F.coalesce(F.sum("given").over(siblings), F.lit(0.0)), F.lit(0.0))
    without = F.sum(F.when(F.col("given").isNull(), 1).otherwise(0)).over(siblings)
    return (met.withColumn("_left", left).withColumn("_n", without)
            .withColumn("weight", F.coalesce("given", F.col("_left") / F.col("_n"))).drop("_left", "_n", "given"))


def leaf_budgets(leaves: DataFrame, tree: list[str], budget: Column | float, weights: dict[tuple, float] | None = None,
                 max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(tree.., tokens, budget)`` of each leaf; ``leaves`` has ``tokens``.
    ``weights`` maps paths, such as ``("web",)`` or ``("web", "en")``."""
    top = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("all"))
    total = budget if isinstance(budget, Column) else F.lit(float(budget))
    parent, above = top.select(total.cast("double").alias("total")), []
    for d in range(1, len(tree) + 1):
        path = list(tree[:d])
        nodes = leaves.groupBy(*path).agg((F.sum("tokens") * max_epochs).cast("double").alias("supply"))
        nodes = _weights(nodes, path, weights)
        met = _meet(nodes, parent, above) if above else nodes.crossJoin(parent)  # the root is one row
        filled = _fill(met, above or [F.lit(0)])
        parent, above = filled.select(*path, F.col("budget").alias("total")), path
    return _meet(leaves, parent, tree).select(
        *tree, "tokens", F.floor(F.col("total") + 1e-6).cast("bigint").alias("budget"))


def mix(docs: DataFrame, tree: list[str] = list(TREE), weights: dict[tuple, float] | None = None,
        budget: float | None = None, share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
        id_col: str = "doc_id", text_col: str = "text", bins: int = BINS) -> DataFrame:
    """``docs`` as often as they are selected, with ``n_tokens`` and
    ``epoch`` (from 0); a tree column must be a column of ``docs``.  Without
    ``budget``, the ``share`` of all tokens is the budget."""
    tok, ep = free_name(docs, "n_tokens"), free_name(docs, "epoch")
    leaf = [f"_leaf{i}" for i in range(len(tree))]
    text = F.col(text_col).cast("string")
    # one narrow row per document: its leaf, its tokens, and what its place in an epoch follows from
    narrow = written(docs.select(*[F.col(c).alias(x) for c, x in zip(tree, leaf)], n_tokens(text).alias("_t"),
                                 F.col(id_col).cast("string").alias("_id"), text_hash(text).alias("_m")), "metered")
    leaves = written(narrow.groupBy(*leaf).agg(F.sum("_t").alias("tokens")), "leaves")
    wanted = F.lit(float(budget)) if budget is not None else F.floor(F.col("all") * share)
    plan = leaf_budgets(leaves, leaf, wanted, weights, max_epochs)
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("int")
    plan = written(plan.withColumn("_whole", whole).withColumn(
        "_rest", F.col("budget") - F.col("_whole") * F.col("tokens")).drop("tokens", "budget"), "budgets")

    key = order_key(seed, F.col("_whole"), F.col("_id"), F.col("_m"))
    placed = _meet(narrow, plan.filter("_rest > 0"), leaf).select(
        *leaf, "_t", "_rest", key.alias("_key")).withColumn(
        "_bin", F.floor(F.col("_key") / ((1 << 60) // bins)).cast("int"))
    sums = placed.groupBy(*leaf, "_bin", "_rest").agg(F.sum("_t").alias("t"))
    before = Window.partitionBy(*leaf).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("t").over(before), F.lit(0)))
    # the bin in which the prefix ends: the first that does not fit whole
    ends = written(sums.filter(F.col("_before") + F.col("t") > F.col("_rest")).groupBy(*leaf).agg(
        F.min("_bin").alias("_end"), F.min_by("_before", "_bin").alias("_sofar")), "prefix-ends")
    edge = _meet(placed, ends, leaf).filter("_bin = _end")
    # equal keys are equal rows: all of them fit, or none
    running = Window.partitionBy(*leaf).orderBy("_key").rangeBetween(Window.unboundedPreceding, 0)
    fits = F.col("_sofar") + F.sum("_t").over(running) <= F.col("_rest")
    low = F.col("_end").cast("bigint") * ((1 << 60) // bins) - 1
    cuts = edge.withColumn("_fits", F.when(fits, F.col("_key"))).groupBy(*leaf).agg(
        F.coalesce(F.max("_fits"), F.max(low)).alias("_cut"))
    prefix = written(_meet(plan, cuts, leaf, "left").select(
        *leaf, "_whole", F.coalesce("_cut", F.lit(-1)).alias("_cut")), "prefixes")

    # names that the documents' own columns do not have
    mine = {c: free_name(docs, c) for c in [*leaf, "_whole", "_cut", "_n"]}
    prefix = prefix.select(*[F.col(c).alias(mine[c]) for c in [*leaf, "_whole", "_cut"]])
    whole, cut, n = F.col(mine["_whole"]), F.col(mine["_cut"]), mine["_n"]
    at = docs.join(prefix, [F.col(c).eqNullSafe(F.col(mine[x])) for c, x in zip(tree, leaf)])
    place = order_key(seed, whole, F.col(id_col).cast("string"), text_hash(text))
    picked = at.withColumn(n, whole + F.when(place <= cut, 1).otherwise(0)).filter(F.col(n) > 0).withColumn(tok, n_tokens(text))
    picked = picked.withColumn(ep, F.explode(F.sequence(F.lit(0), F.col(n) - 1)))
    return picked.select(*docs.columns, tok, ep)

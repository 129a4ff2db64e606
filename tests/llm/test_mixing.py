import hashlib
import math

import pytest
from pyspark.sql import functions as F

from topicgraph.llm import mixing as M


def n_tokens(t):
    return len([w for w in (t or "").replace("\t", " ").replace("\n", " ").split(" ") if w])


def fill(children, budget):
    """children: {name: (weight, supply)}: give by weight, hand back what does not fit, again and again."""
    got, open_ = {c: 0.0 for c in children}, {c for c, (w, _) in children.items() if w > 0}
    while open_ and budget > 1e-9:
        total = sum(children[c][0] for c in open_)
        step = min((children[c][1] - got[c]) / children[c][0] for c in open_)
        step = min(step, budget / total)
        for c in list(open_):
            got[c] += step * children[c][0]
            budget -= step * children[c][0]
            if got[c] >= children[c][1] - 1e-9:
                open_.remove(c)
    return got


def budgets(leaves, weights, total, epochs, path=()):
    depth = len(next(iter(leaves)))
    if len(path) == depth:
        return {path: total}
    names = sorted({k[len(path)] for k in leaves if k[:len(path)] == path}, key=repr)
    given = {n: weights[path + (n,)] for n in names if path + (n,) in weights}
    level = any(len(k) == len(path) + 1 for k in weights)
    rest = max(0.0, 1 - sum(given.values()))
    def weight(n):
        return given[n] if n in given else rest / (len(names) - len(given)) if level else 1.0
    supply = {n: epochs * sum(t for k, t in leaves.items() if k[:len(path) + 1] == path + (n,)) for n in names}
    part = fill({n: (weight(n), supply[n]) for n in names}, total)
    out = {}
    for n in names:
        out |= budgets(leaves, weights, part[n], epochs, path + (n,))
    return out


def brute(rows, weights, budget, epochs, seed=M.SEED):
    """rows: (doc_id, text, d, l, s) -> sorted (doc_id, text, epoch)."""
    leaves = {}
    for _, t, *leaf in rows:
        leaves[tuple(leaf)] = leaves.get(tuple(leaf), 0) + n_tokens(t)
    out = []
    for leaf, b in budgets(leaves, weights, float(budget), epochs).items():
        b = math.floor(b + 1e-6)
        if not leaves[leaf]:
            continue
        whole, rest = divmod(b, leaves[leaf])
        docs = [(i, t) for i, t, *x in rows if tuple(x) == leaf]
        out += [(i, t, e) for i, t in docs for e in range(whole)]
        def key(d):
            m = hashlib.md5((d[1] or "").encode()).hexdigest()
            return int(hashlib.md5(f"{seed}:{whole}:{'' if d[0] is None else d[0]}:{m}".encode()).hexdigest()[:15], 16)
        used = 0
        for k in sorted({key(d) for d in docs}):
            same = [d for d in docs if key(d) == k]
            used += sum(n_tokens(t) for _, t in same)
            if used > rest or not rest:
                break
            out += [(i, t, whole) for i, t in same]
    return sorted(out, key=repr)


ROWS = [(i, " ".join(["w"] * (1 + i * 7 % 23)), f"d{i % 3 % 2}", "en" if i % 5 else "fr", f"s{i % 4}") for i in range(150)]
ROWS += [(3, ROWS[3][1], *ROWS[3][2:]), (1000, None, "d0", "en", "s0"), (1001, "", "d1", None, None), (None, "a b", None, "en", "s1"),
         (1002, "x " * 5000, "d1", "en", "s1"), (1003, " \t", "empty", "en", "s0")]
SCHEMA = "doc_id bigint, text string, domain string, lang string, source string"


@pytest.mark.parametrize("weights, budget, epochs, bins", [
    ({}, 700, 1, 4096), ({("d0",): 0.7, ("d1",): 0.2, ("d1", "fr"): 0.9}, 900, 2, 8), ({("d0",): 0.99, ("d1",): 0.0}, 9000, 3, 1),
    ({("d1", "en", "s1"): 0.5}, 10**6, 2, 64)])
def test_against_brute_force(spark, weights, budget, epochs, bins):
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumn("epoch", F.lit("x"))
    got = M.mix(docs, weights=weights, budget=budget, max_epochs=epochs, bins=bins)
    assert got.columns[:len(docs.columns)] == docs.columns
    have = sorted(((r.doc_id, r.text, r.epoch_) for r in got.collect()), key=repr)
    assert have == brute(ROWS, weights, budget, epochs)


def test_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "x", 10), ("a", "y", 1000), ("b", "z", 1000)], "d string, l string, tokens bigint")
    plan = {(r.d, r.l): r.budget for r in M.leaf_budgets(leaves, ["d", "l"], 400.0, max_epochs=1).collect()}
    assert plan == {("a", "x"): 10, ("a", "y"): 190, ("b", "z"): 200}


def test_empty_and_no_budget(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    assert M.mix(docs.limit(0)).collect() == []
    assert M.mix(docs, budget=0).collect() == []

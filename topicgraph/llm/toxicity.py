"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a
block-max inverted index.

Fit.  A bounded sample of labelled documents (``TOXIC`` and ``CLEAN``
examples at most) is the set of examples.  Their terms are words and word
beginnings of 4, 5 and 6 characters (so that inflected forms meet), and for
what a text says 2, 4, 8, ... times one more term each (a cosine does not see
how often a text says the one thing that counts).  Spark counts each term's
examples of both classes, and at most ``TERMS`` terms that tell the classes
apart are kept.  How strict that choice is, and the curve that turns votes
into probabilities, are found by leaving each example out once and asking the
others.

Index.  Examples lie in blocks of ``BLOCK``.  A term's postings are grouped
by block with the block's largest weight.  For a text, the largest weights
bound every block's cosine; the blocks with the largest bounds are read first,
and then all others whose bound reaches the K-th neighbour found so far, so
the K nearest are exact.

Score.  The neighbours vote with weights that fall with their distance, next
to one vote of the base rate; the vote passes the fitted curve.  The model is
a few megabytes by its documented bounds, and each text is scored where it
is read: whole texts, no shuffle of documents.  A text's score depends on
its words alone.

Defined results: null, empty and unknown texts have no neighbour and get the
score of the base rate; without any example the score is 0.  Repeated labels
of an id count once, toxic if any is; null labels or ids are not learnt from.
Of repeated documents one is learnt from and all are scored.  Ties between
neighbours go to the example with the smaller place in the sample.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fold, free_name, slices
from .decontamination import words

#: Bounds of the model: examples of each class, and terms.
TOXIC, CLEAN, TERMS = 2048, 4096, 4096
#: Neighbours that vote, examples in an index block, and blocks read before
#: the bounds are compared.
K, BLOCK, FIRST = 16, 64, 4
#: A term is in at least so many examples; strictness of the choice (standard
#: scores of the difference between classes) that are tried.
LEAST_EXAMPLES, STRICTNESS = 5, (4.0, 6.0, 9.0, 12.0)
#: Word beginnings that are terms of their own.
BEGINNINGS = (4, 5, 6)
#: Counts from which on a text has a term once more.
GRADES = (2, 4, 8, 16, 32, 64)
#: Folds of the ids; fold 0 is held out.
FOLDS = 5
#: Words and neighbour lists that a worker remembers at most.
WORDS, LISTS = 100_000, 5_000

EVIDENCE = "array<struct<doc_id: string, toxic: int, similarity: double>>"


def terms_of(word: bytes) -> list[str]:
    w = word.decode("utf-8", "replace")
    return [w] + [f"{k}:{w[:k]}" for k in BEGINNINGS if len(w) > k]


def graded(counts: Counter) -> dict[str, int]:
    """The counts, with one more term for each power of two that a term's
    count reaches (``*`` is in no word)."""
    out = dict(counts)
    for t, n in counts.items():
        for k in GRADES:
            if n >= k:
                out[f"{t}*{k}"] = 1
    return out


def term_counts(text: str | None) -> dict[str, int]:
    out: Counter = Counter()
    for w, n in Counter(words(text)).items():
        for t in terms_of(w):
            out[t] += n
    return graded(out)


class BlockMaxIndex:
    """Postings of the examples by term and block.  Examples that share their
    heaviest terms lie side by side, so that blocks are alike inside and their
    largest weights bound them closely."""

    def __init__(self, vectors: list[dict[int, float]], terms: int):
        import numpy as np

        heaviest = [tuple(sorted(v, key=lambda t: (-v[t], t))[:3]) for v in vectors]
        self.example = np.array(sorted(range(len(vectors)), key=lambda e: (heaviest[e], e)), np.int64)
        self.blocks = -(-len(vectors) // BLOCK)
        by_term: list[list[tuple[int, float]]] = [[] for _ in range(terms)]
        for place, e in enumerate(self.example.tolist()):
            for t, x in vectors[e].items():
                by_term[t].append((place, x))
        self.postings, self.tops = [], []
        for plist in by_term:
            at = np.array([p for p, _ in plist], np.int64)
            val = np.array([x for _, x in plist], np.float64)
            first = np.flatnonzero(np.diff(at // BLOCK, prepend=-1))
            self.postings.append((at, val, first, np.diff(first, append=len(at))))
            self.tops.append((at[first] // BLOCK, np.maximum.reduceat(val, first) if len(at) else val))

    def _add(self, score, vector: dict[int, float], wanted) -> None:
        """Adds the query's products with the postings of the wanted blocks."""
        import numpy as np

        for t, x in vector.items():
            at, val, first, size = self.postings[t]
            use = wanted[self.tops[t][0]]
            if not use.all():
                start, n = first[use], size[use]
                cut = np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())
                at, val = at[cut], val[cut]
            score[at] += x * val

    def nearest(self, vector: dict[int, float], k: int) -> list[tuple[float, int]]:
        """The ``k`` examples with the largest cosine above zero, as
        ``(cosine, example)``."""
        import numpy as np

        bound = np.zeros(self.blocks)
        for t, x in vector.items():
            at, top = self.tops[t]
            bound[at] += x * top
        score = np.zeros(self.blocks * BLOCK)
        first = np.zeros(self.blocks, bool)
        first[np.argsort(-bound, kind="stable")[:FIRST]] = True
        self._add(score, vector, first)
        floor = float(np.partition(score, -k)[-k]) if len(score) >= k else 0.0
        # rounding differs between the bound and the sum: a margin keeps the search exact
        rest = ~first & (bound > 0) & (bound >= floor - 1e-9)
        if rest.any():
            self._add(score, vector, rest)
            floor = float(np.partition(score, -k)[-k]) if len(score) >= k else 0.0
        found = np.flatnonzero((score > 0) & (score >= floor - 1e-9))
        order = np.lexsort((self.example[found], -np.round(score[found], 9)))[:k]
        return [(float(score[i]), int(self.example[i])) for i in found[order]]


class Model:
    """Examples, index, and the curve from votes to probabilities."""

    def __init__(self, terms: list[str], idf: list[float], examples: list[tuple[str, int, dict[int, int]]],
                 base_rate: float):
        # each word or beginning that a term is made of, with the counts that give a term
        self.steps: dict[str, list[tuple[int, int]]] = {}
        for i, t in enumerate(terms):
            base, _, k = t.partition("*")
            self.steps.setdefault(base, []).append((int(k or 1), i))
        self.idf = idf
        self.ids = [i for i, _, _ in examples]
        self.labels = [y for _, y, _ in examples]
        self.base_rate = base_rate
        self.curve = (1.0, 0.0)
        self.vectors = [self.unit(c) for _, _, c in examples]
        self.index = BlockMaxIndex(self.vectors, len(terms))
        positives = max(1, sum(self.labels))
        # examples of a class stand for that class's share of all documents
        self.weight = {1: base_rate / positives, 0: (1 - base_rate) / max(1, len(examples) - positives)}

    def plain(self) -> dict:
        """What it is made of, as plain values: a broadcast is unpickled where
        this package may be missing."""
        return {**vars(self), "index": vars(self.index)}

    @classmethod
    def received(cls, state: dict) -> "Model":
        out, index = cls.__new__(cls), BlockMaxIndex.__new__(BlockMaxIndex)
        index.__dict__.update(state["index"])
        out.__dict__.update({**state, "index": index})
        return out

    def unit(self, counts: dict[int, int]) -> dict[int, float]:
        """TF-IDF vector of length 1."""
        v = {t: (1 + math.log(n)) * self.idf[t] for t, n in sorted(counts.items())}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()}

    def counted(self, counts: dict[str, int]) -> dict[int, int]:
        """Numbers of the model's terms, from counts of words and beginnings."""
        return {i: n if k == 1 else 1 for t, n in counts.items() for k, i in self.steps[t] if n >= k}

    def vote(self, near: list[tuple[float, int]]) -> float:
        """Share of toxic votes; the base rate has one vote."""
        votes, toxic = 0.1, 0.1 * self.base_rate
        for cosine, e in near:
            w = cosine / (0.1 + math.sqrt(max(0.0, 2 - 2 * cosine)))
            votes += w
            toxic += w * self.labels[e]
        return toxic / votes

    def probability(self, vote: float) -> float:
        a, b = self.curve
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a * logit(vote) + b))))

    def fit_curve(self) -> float:
        """Fits the curve on votes with each example left out; returns the
        weighted loss."""
        import numpy as np

        near: dict[tuple, list] = {}  # examples with equal vectors have equal neighbours
        x = np.zeros(len(self.vectors))
        for e, v in enumerate(self.vectors):
            key = tuple(v.items())
            if key not in near:
                near[key] = self.index.nearest(v, K + 1)
            x[e] = logit(self.vote([n for n in near[key] if n[1] != e][:K]))
        y = np.array(self.labels, float)
        w = np.array([self.weight[label] for label in self.labels]) * len(self.labels)
        a, b = 1.0, 0.0
        for _ in range(50):  # Newton steps of logistic regression, with a slight pull to (1, 0)
            p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
            g = np.array([np.sum(w * (p - y) * x) + a - 1, np.sum(w * (p - y)) + b])
            s = w * p * (1 - p)
            h = np.array([[np.sum(s * x * x) + 1, np.sum(s * x)], [np.sum(s * x), np.sum(s) + 1]])
            step = np.linalg.solve(h, g)
            a, b = a - step[0], b - step[1]
            if np.abs(step).max() < 1e-9:
                break
        self.curve = (max(float(a), 0.1), float(b))
        p = np.clip(np.array([self.probability(1 / (1 + math.exp(-v))) for v in x]), 1e-9, 1 - 1e-9)
        return float(-np.sum(w * (y * np.log(p) + (1 - y) * np.log(1 - p))))


def logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, toxic: int, clean: int,
           learn: Column | None) -> tuple[DataFrame, float]:
    """``(doc_id, toxic, text)`` of at most ``toxic + clean`` examples, and
    the share of toxic labels."""
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("toxic"))
    if learn is not None:
        known = known.filter(learn)
    known = (known.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n = known.agg(F.count("*").alias("n"), F.sum("toxic").alias("y")).first()
    rate = (n.y or 0) / n.n if n.n else 0.0
    order = F.xxhash64("doc_id")
    chosen = [known.filter(F.col("toxic") == y).orderBy(order, "doc_id").limit(m) for y, m in ((1, toxic), (0, clean))]
    ids = chosen[0].unionByName(chosen[1])
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # at most toxic + clean rows: a bounded broadcast
    return texts.join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"]), rate


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        toxic: int = TOXIC, clean: int = CLEAN, learn: Column | None = None) -> Model:
    """The model, learnt from the labels for which ``learn`` (a condition on
    ``doc_id``) holds."""
    examples, rate = sample(docs, labels, id_col, text_col, label_col, toxic, clean, learn)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            rows = [(i.as_py(), y.as_py(), term_counts(t.as_py())) for i, t, y in zip(*b.columns)]
            for i, y, counts in rows:
                k = max(1, len(counts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i] * k, pa.string()), pa.array([y] * k, pa.int32()),
                     pa.array(list(counts) or [None], pa.string()), pa.array(list(counts.values()) or [0], pa.int32())],
                    ["doc_id", "toxic", "term", "n"])

    counted = examples.select(F.col("doc_id").cast("string"), "text", "toxic").mapInArrow(
        run, "doc_id string, toxic int, term string, n int")
    from .common import written
    counted = written(counted, "example-terms")
    per_class = {r.toxic: r.n for r in counted.select("doc_id", "toxic").distinct()
                 .groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = per_class.get(1, 0), per_class.get(0, 0)
    if not n1 or not n0:
        return Model([], [], [], rate)
    share = (F.col("a") + F.col("b")) / F.lit(float(n1 + n0))
    z = (F.col("a") / n1 - F.col("b") / n0) / F.sqrt(share * (1 - share) * (1 / n1 + 1 / n0) + 1e-12)
    chosen = (counted.filter("term IS NOT NULL").groupBy("term")
              .agg(F.sum("toxic").alias("a"), F.sum(F.lit(1) - F.col("toxic")).alias("b"))
              .filter(F.col("a") + F.col("b") >= LEAST_EXAMPLES).withColumn("z", F.abs(z))
              .filter(F.col("z") >= min(STRICTNESS)).orderBy(F.desc("z"), "term").limit(TERMS)).collect()
    # one row per example, its terms as numbers
    numbers = docs.sparkSession.createDataFrame(
        [(r.term, i) for i, r in enumerate(chosen)] or [("", -1)], "term string, number int")
    said = counted.join(F.broadcast(numbers), "term").groupBy("doc_id").agg(
        F.collect_list(F.struct("number", "n")).alias("said"))
    held = {r.doc_id: (r.toxic, [], []) for r in counted.select("doc_id", "toxic").distinct().collect()}
    for r in said.select("doc_id", "said.number", "said.n").collect():
        held[r.doc_id] = (held[r.doc_id][0], r.number, r.n)

    best = None
    for least in STRICTNESS:
        used = sorted((i for i, r in enumerate(chosen) if r.z >= least), key=lambda i: chosen[i].term)
        place = {i: j for j, i in enumerate(used)}
        terms = [chosen[i].term for i in used]
        idf = [math.log((n1 + n0 + 1) / (chosen[i].a + chosen[i].b + 1)) + 1 for i in used]
        rows = [(d, y, {place[i]: n for i, n in zip(terms_, counts) if i in place})
                for d, (y, terms_, counts) in sorted(held.items())]
        model = Model(terms, idf, rows, rate)
        loss = model.fit_curve()
        if best is None or loss < best[0]:
            best = (loss, model)
    return best[1]


class Scorer:
    """Scores texts in a worker, with a bounded memory of words and votes."""

    def __init__(self, model: Model):
        self.model, self.seen, self.known = model, {}, {}

    def __call__(self, text: str | None) -> tuple[float, list]:
        if len(self.seen) > WORDS:
            self.seen = {}
        if len(self.known) > LISTS:
            self.known = {}
        counts: Counter = Counter()
        seen, steps = self.seen, self.model.steps
        for w, n in Counter(words(text)).items():
            hits = seen.get(w)
            if hits is None:
                hits = seen[w] = tuple(t for t in terms_of(w) if t in steps)
            for t in hits:
                counts[t] += n
        m = self.model
        vector = m.counted(counts)
        key = tuple(sorted(vector.items()))
        if key not in self.known:
            near = m.index.nearest(m.unit(vector), K) if key else []
            self.known[key] = (m.probability(m.vote(near)) if m.ids else 0.0, near)
        score, near = self.known[key]
        return score, [{"doc_id": m.ids[e], "toxic": m.labels[e], "similarity": s} for s, e in near]


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with the struct column ``out``: ``score`` and ``evidence``
    (the nearest examples)."""
    docs = docs.withColumn(text_col, F.col(text_col).cast("string"))
    kind = f"struct<score: double, evidence: {EVIDENCE}>"
    schema = T.StructType([*docs.schema, T.StructField(out, T._parse_datatype_string(kind))])
    sent = docs.sparkSession.sparkContext.broadcast(model.plain())

    def run(batches):
        import pyarrow as pa

        scorer = Scorer(Model.received(sent.value))
        entry = pa.struct([("doc_id", pa.string()), ("toxic", pa.int32()), ("similarity", pa.float64())])
        for b in slices(batches, 512):
            got = [scorer(t.as_py()) for t in b.column(text_col)]
            rows = pa.array([{"score": s, "evidence": e} for s, e in got],
                            pa.struct([("score", pa.float64()), ("evidence", pa.list_(entry))]))
            yield b.append_column(out, rows)

    return docs.mapInArrow(run, schema)


def reject(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without those that score ``threshold`` or more."""
    out = free_name(docs, "toxicity")
    return score(docs, model, text_col, out).filter(F.col(f"{out}.score") < threshold).select(*docs.columns)


def held_out(doc_id: Column) -> Column:
    return fold(doc_id, FOLDS) == 0

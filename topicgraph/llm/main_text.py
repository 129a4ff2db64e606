"""Main text of web pages by the maximum-scoring subsequence.

A page is a sequence of words and tags.  Words score positive and tags
negative, and one linear scan finds the contiguous stretch with the highest
sum: the region of the main text (Pasternack and Roth, WWW 2009).

The weights come from the labelled pages: those that mark their main text
with ``article`` or ``main``.  One pass counts, over all of them, how often
each kind of tag, a word in each kind of place (its block, and whether it is in
a link), and each word of a class, id or role lies inside and outside of that
mark; a weight is the log ratio, kept above zero for words and below zero for
tags.  The mark is the label and nothing else: its tags are no features and add
nothing to a score, so a page without it is cut in the same way.  The features
come from fixed lists, so the counts are a few hundred numbers; they are summed
by Spark and sent to the second pass, which cuts every page.

Elements that never belong to an article (scripts, menus, sidebars, forms, ...)
are boxes: as a whole they count as one tag, and their text is left out if the
region surrounds them.  So is an element whose class, id or role words say in
sum that it lies outside (adverts, notices, reader comments).  The words looked
for are a fixed list, their weights are learnt; what no labelled page has keeps
the list's own guess (``GUESS`` counts).

Defined results: a null or empty page has the empty text.  White space (as
Unicode has it) inside a block becomes one space; blocks are joined by one
space.  Broken markup is read as it comes: unclosed elements end with their
parent, an unclosed comment or script runs to the end.  Repeated pages stay
as rows; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements of HTML by their use.
MARKS = frozenset("article main".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object canvas".split())
BOXES = frozenset("nav aside form footer header menu dialog button select fieldset head".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
KNOWN = MARKS | RAW | BOXES | INLINE | VOID | HEADINGS | frozenset(
    "address blockquote body caption center dd details div dl dt figcaption figure hgroup html li ol p pre section "
    "summary table tbody td tfoot th thead tr ul".split())
#: Words of a class, id or role that may name a box beside the text.
BESIDE = frozenset(
    "ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs byline comment comments "
    "consent cookie cookies copyright disclaimer discussion disqus footer form gdpr header hidden legal login masthead "
    "menu modal nav navbar navigation newsletter notice notification pagination pager popup promo promotion "
    "recommended recommendations related replies reply search share sharing sidebar signup social sponsor sponsored "
    "subscribe tags toolbar widget".split())
#: Words of a class or id that may name the text or a part of it.
WITHIN = frozenset("article post entry story content main".split())

TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*+"|'[^']*+')*+)>""")
NAME = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
NAME_WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

#: Added to each count, so that weights exist without any labelled page.
PRIOR = 1.0
#: Counts that the lists of class words stand for.
GUESS = 3.0
#: The least a word adds and a tag takes.
LEAST = 0.25


def events(page: str | None) -> Iterator[tuple[str, str, str]]:
    """``(kind, name, rest)``: text, open and close events in page order."""
    page = page or ""
    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield "text", "", page[at:]
            return
        if lt > at:
            yield "text", "", page[at:lt]
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if page[lt + 1:lt + 2] in ("!", "?"):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        m = TAG.match(page, lt)
        if m is not None:
            at, closes, name, rest = m.end(), m[1], m[2].lower(), m[3]
        else:
            m = NAME.match(page, lt)
            end = page.find(">", lt)
            if m is None or end < 0:
                if m is None and page[lt + 1:lt + 2] != "/":
                    yield "text", "", "<"
                    at = lt + 1
                else:
                    at = n if end < 0 else end + 1
                continue
            # a quote that never closes: the tag ends at the first '>'
            at, closes, name, rest = end + 1, m[1], m[2].lower(), ""
        if closes:
            yield "close", name, ""
            continue
        yield "open", name, rest
        if name in RAW and not rest.endswith("/"):
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else n
            yield "close", name, ""


def class_words(attributes: str) -> set[str]:
    """The listed words in the class, id and role of an element."""
    if "=" not in attributes:
        return set()
    found: set[str] = set()
    for _, value in ATTRIBUTE.findall(attributes):
        found |= set(NAME_WORD.findall(CAMEL.sub(" ", value).lower()))
    return found & (BESIDE | WITHIN)


def tokens(page: str | None, weight: dict[str, float] | None = None) -> list[tuple[str, str, object]]:
    """``(kind, feature, value)``: words (a count and the raw text), tags,
    boxes, and (without weights) marks and classes.  A feature names what the
    weights are learnt for; with ``weight``, elements whose class words weigh
    less than nothing are boxes too."""
    out: list[tuple[str, str, object]] = []
    stack: list[str] = []
    box: list[str] = []  # open elements from the box inwards
    for kind, name, rest in events(page):
        box_ended = False
        if box == ["p"] and kind == "open" and name not in INLINE and name not in VOID:
            box = []  # the next block ends a paragraph
        if box:
            if kind == "open" and name not in VOID and not rest.endswith("/"):
                box.append(name)
            elif kind == "close" and name in box:
                while box and box.pop() != name:
                    pass
            elif kind == "close" and name in stack and name not in INLINE:
                box = []  # its parent ends
                box_ended = True
            if box or not box_ended:
                continue
        known = name if name in KNOWN else "other"
        if kind == "text":
            block = next((e for e in reversed(stack) if e not in INLINE and e not in MARKS), "body")
            place = f"word:{block if block in KNOWN else 'other'}" + (":a" if "a" in stack else "")
            out.append(("word", place, (len(rest.split()), rest)))
        elif kind == "open":
            # a header in another element than the body holds a title of the text
            inner = any(e not in INLINE and e not in ("body", "html") for e in stack)
            plain = name in RAW or name in BOXES and not (name == "header" and inner)
            said = class_words(rest) if not plain and name not in ("body", "html") else set()
            against = sum(weight.get(f"class:{w}", 0.0) for w in said) if weight is not None else 0.0
            if plain or against < 0 and name not in HEADINGS and name not in MARKS:
                out.append(("box", f"box:{known}" if plain else "box:class", name))
                if name not in VOID and not rest.endswith("/"):
                    box = [name]
                continue
            if weight is None:
                out += [("class", f"class:{w}", "") for w in sorted(said)]
            if name in MARKS:
                out.append(("mark", "open", name))
            else:
                out.append(("tag", f"<{known}>", name))
            if name not in VOID:
                stack.append(name)
        else:
            if name in stack:
                while stack and stack.pop() != name:
                    pass
            out.append(("mark", "close", name) if name in MARKS else ("tag", f"</{known}>", name))
    return out


def label_counts(page: str | None) -> Counter:
    """How often each feature lies inside (True) and outside of the marked
    text; empty for a page without a mark."""
    toks = tokens(page)
    opens = [i for i, t in enumerate(toks) if t[:2] == ("mark", "open")]
    closes = [i for i, t in enumerate(toks) if t[:2] == ("mark", "close")]
    counts: Counter = Counter()
    if not opens:
        return counts
    first, last = opens[0], closes[-1] if closes and closes[-1] > opens[0] else len(toks)
    for i, (kind, feature, value) in enumerate(toks):
        if kind != "mark":
            counts[feature, first < i < last] += value[0] if kind == "word" else 1
    return counts


def weights(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Log ratios of the counts: above zero for words, below zero for tags and
    boxes, either for classes.  Each kind is compared with its own total."""
    out = {}
    kinds = {"word": lambda f: f.startswith("word:"), "class": lambda f: f.startswith("class:"),
             "tag": lambda f: f[0] == "<" or f.startswith("box:")}
    for kind, of in kinds.items():
        held = {f: [counts.get((f, side), 0) + PRIOR for side in (True, False)] for f in {f for f, _ in counts} if of(f)}
        if kind == "class":
            for words, side in ((BESIDE, 1), (WITHIN, 0)):
                for w in words:
                    held.setdefault(f"class:{w}", [PRIOR, PRIOR])[side] += GUESS
        # elements with any class at all say nothing: classes are compared with each other's prior
        inside, outside = (1.0, 1.0) if kind == "class" else [sum(v[i] for v in held.values()) or 1.0 for i in (0, 1)]
        for f, (x, y) in held.items():
            ratio = math.log(x / inside / (y / outside))
            out[f] = max(ratio, LEAST) if kind == "word" else min(ratio, -LEAST) if kind == "tag" else ratio
    return out


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous part with the highest sum, the first
    of equal ones; empty if no score is above zero."""
    best, region = 0.0, (0, 0)
    total, start = 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, region = total, (start, i + 1)
    return region


def main_text(page: str | None, weight: dict[str, float]) -> str:
    toks = tokens(page, weight)
    scores = [0.0 if k == "mark" else weight.get(f, LEAST) * v[0] if k == "word" else weight.get(f, -LEAST) for k, f, v in toks]
    start, end = best_region(scores)
    blocks: list[str] = []
    line: list[str] = []
    for kind, _, value in toks[start:end]:
        if kind == "word":
            line.append(html.unescape(value[1]))
        elif kind == "tag" and value in INLINE:
            if value in ("br", "img"):
                line.append(" ")
        elif kind != "box" or value not in INLINE:
            blocks.append("".join(line))
            line = []
    blocks.append("".join(line))
    return " ".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def learn(pages: DataFrame, html_col: str = "html") -> dict[str, float]:
    """The weights, from all pages that mark their main text."""
    def run(batches):
        import pyarrow as pa

        counts: Counter = Counter()
        for b in batches:
            for page in b.column(0):
                counts.update(label_counts(page.as_py()))
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.bool_()),
             pa.array([counts[k] for k in keys], pa.int64())], ["feature", "inside", "n"])

    narrow = pages.select(F.col(html_col).cast("string").alias("html"))
    rows = narrow.mapInArrow(run, "feature string, inside boolean, n bigint")
    # features are built from the fixed list of elements: a few hundred rows at most
    return weights({(r.feature, r.inside): r.n
                    for r in rows.groupBy("feature", "inside").agg(F.sum("n").alias("n")).collect()})


def extract(pages: DataFrame, weight: dict[str, float] | None = None, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)``, one row per page."""
    weight = learn(pages, html_col) if weight is None else weight
    narrow = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                          F.col(html_col).cast("string").alias("html"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            texts = pa.array([main_text(p.as_py(), weight) for p in b.column(2)], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), texts], ["page_id", "url", "text"])

    schema = T.StructType([narrow.schema["page_id"], narrow.schema["url"], T.StructField("text", T.StringType())])
    return narrow.mapInArrow(run, schema).withColumn("n_chars", F.length("text").cast("bigint"))

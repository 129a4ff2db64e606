"""Message analysis as built-in column expressions (no Python UDF).

``analyze`` is the emoji-aware analyser: drop ZWJ, map standalone emoticons
to emoji, split on Java whitespace, lower-case, strip ASCII punctuation,
variation selectors and skin tones, drop empty tokens.  Synonym expansion is
*not* done per row: the token table (``token_table``) expands with a
broadcast join against the bounded synonym dictionary, and topic matching
expands the query side instead (``match_set``), which is equivalent and
leaves the per-row work to one ``arrays_overlap``.

The character classes are written so the same pattern text runs in Java
regex (Spark) and RE2 (DuckDB oracles).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import emoji

# fixed values: Java Character.isWhitespace, written as an explicit class
WS_CLASS = (r"[\t\n\x{0B}\f\r\x{1C}-\x{20}\x{1680}\x{2000}-\x{2006}"
            r"\x{2008}-\x{200A}\x{2028}\x{2029}\x{205F}\x{3000}]")
# fixed values: POSIX punctuation, text/emoji variation selectors, skin tones
PUNCT_CLASS = r"[!-/:-@\[-`{-~\x{FE0E}\x{FE0F}\x{1F3FB}-\x{1F3FF}]"
ZWJ = r"\x{200D}"
# standard-tokenizer approximation of the unanalysed mapping (variant A)
WORD_SPLIT = r"[^\p{L}\p{N}_]+"
SHORTCODE = r":[^\s:]+:"


def _emoticon_regex(emoticons: dict[str, str] | None = None) -> str:
    alts = sorted(emoji.emoticon_chars() if emoticons is None else emoticons, key=lambda e: (-len(e), e))
    return "^(" + "|".join(re.escape(a) for a in alts) + r")([|?.,!].*)?$"


EMOTICON_RE = _emoticon_regex()


def _literal_map(d: dict) -> Column:
    # constant-folded by Catalyst into a map literal
    return F.from_json(F.lit(emoji.as_json(d)), "map<string,string>")


def emoticon_token(t: Column, emoticons: dict[str, str] | None = None) -> Column:
    """A token that is an emoticon (optionally followed by ``|?.,!`` and
    anything) becomes the emoji plus that rest."""
    table = emoji.emoticon_chars() if emoticons is None else emoticons
    pattern = EMOTICON_RE if emoticons is None else _emoticon_regex(emoticons)
    m = F.regexp_extract(t, pattern, 1)
    rest = F.regexp_extract(t, pattern, 2)
    return F.when(m != "", F.concat(F.element_at(_literal_map(table), m), rest)).otherwise(t)


# runs of non-whitespace (tokens); extracted with a pattern compiled once per
# task, whereas ``split`` recompiles its pattern for every row
TOKEN_RUN = "[^" + WS_CLASS[1:-1] + "]+"
# first characters of the emoticons: other tokens skip the emoticon regex
EMOTICON_FIRST = sorted({e[0] for e in emoji.emoticon_chars()})


def _token(t: Column, emoticons: dict[str, str] | None = None) -> Column:
    first = EMOTICON_FIRST if emoticons is None else sorted({e[0] for e in emoticons})
    guarded = F.when(F.substring(t, 1, 1).isin(*first), emoticon_token(t, emoticons)).otherwise(t) if first else t
    return F.regexp_replace(F.lower(guarded), PUNCT_CLASS, "")


def analyze(message: Column | str, emoticons: dict[str, str] | None = None) -> Column:
    """Message -> base tokens (array<string>, NULL for a NULL message);
    ``emoticons`` replaces the built-in table (``sources.dictionaries``)."""
    msg = F.col(message) if isinstance(message, str) else message
    toks = F.regexp_extract_all(F.replace(msg, F.lit("\u200d"), F.lit("")), F.lit(TOKEN_RUN), 0)
    # array_remove is code-generated; a filter lambda would run interpreted
    return F.array_remove(F.transform(toks, lambda t: _token(t, emoticons)), "")


def with_tokens(df, message: str = "message", out: str = "tokens", keep: list[str] | None = None):
    """``df`` with ``out = analyze(message)`` computed once per row.

    The tokens come out of a one-element generator, so later filters and
    projections that read them cannot be rewritten to re-run the analyser
    (filter push-down and project collapsing would otherwise inline it into
    every use)."""
    cols = keep if keep is not None else df.columns
    return df.select(*cols, F.inline(F.array(F.struct(analyze(message).alias(out)))))


def analyze_standard(message: Column | str) -> Column:
    """Lower-case word split (the default analyser of the 4-field index)."""
    msg = F.col(message) if isinstance(message, str) else message
    return F.filter(F.split(F.lower(msg), WORD_SPLIT), lambda t: F.length(t) >= 1)


# ---------------------------------------------------------------------------
# driver-side analysis of a query string (a few characters, no job needed)

_PY_WS = re.compile("[\t\n\x0b\f\r\x1c-\x20\u1680\u2000-\u2006\u2008-\u200a"
                    "\u2028\u2029\u205f\u3000]+")
_PY_PUNCT = re.compile("[!-/:-@\\[-`{-~\ufe0e\ufe0f\U0001F3FB-\U0001F3FF]")
_PY_EMO = re.compile("^(" + "|".join(re.escape(a) for a in sorted(
    emoji.emoticon_chars(), key=lambda e: (-len(e), e))) + r")([|?.,!].*)?$", re.S)


def analyze_text(text: str | None, emoticons: dict[str, str] | None = None) -> list[str]:
    """Python twin of ``analyze`` for query strings."""
    if text is None:
        return []
    emo = emoji.emoticon_chars() if emoticons is None else emoticons
    pattern = _PY_EMO if emoticons is None else re.compile(_emoticon_regex(emoticons), re.S)
    out = []
    for t in _PY_WS.split(text.replace("\u200d", "")):
        m = pattern.match(t) if emo else None
        if m:
            t = emo[m.group(1)] + (m.group(2) or "")
        t = _PY_PUNCT.sub("", t.lower())
        if t:
            out.append(t)
    return out


def topic_term(search: str) -> str:
    """First whitespace-separated word, lower-cased; empty input raises."""
    parts = search.split()
    if not parts:
        raise ValueError("empty topic")
    return parts[0].lower()


def topic_term_column(search: Column | str) -> Column:
    """P3 for a column of search texts; NULL where there is no word."""
    c = F.col(search) if isinstance(search, str) else search
    word = F.regexp_extract(c, "^" + WS_CLASS + "*(" + TOKEN_RUN + ")", 1)
    return F.when(word != "", F.lower(word))


Synonyms = list[tuple[str, list[str]]]


def synonyms(rows: Synonyms | None = None) -> dict[str, list[str]]:
    return {e: w for e, w in (emoji.synonym_rows() if rows is None else rows)}


def expand(tokens: list[str], rows: Synonyms | None = None) -> list[str]:
    """Index-time expansion of a token list (each emoji followed by its words)."""
    syn = synonyms(rows)
    out = []
    for t in tokens:
        out.append(t)
        out.extend(syn.get(t, []))
    return out


def match_set(topic_tokens: list[str], use_synonyms: bool = True, rows: Synonyms | None = None) -> list[str]:
    """Base tokens whose expansion meets the expanded topic.

    A document matches iff ``expand(doc) ∩ expand(topic) ≠ ∅``; that holds
    iff one of its *base* tokens is in this set.  The set is bounded by the
    dictionary size, so it travels as a literal array.
    """
    if not use_synonyms:
        return sorted(set(topic_tokens))
    e = set(expand(topic_tokens, rows))
    m = set(e)
    for ch, words in emoji.synonym_rows() if rows is None else rows:
        if e.intersection(words):
            m.add(ch)
    return sorted(m)


def prefix_emoji(prefix: str, rows: Synonyms | None = None) -> list[str]:
    """Emoji one of whose synonym words starts with ``prefix``."""
    return sorted(ch for ch, words in (emoji.synonym_rows() if rows is None else rows)
                  if any(w.startswith(prefix) for w in words))


# ---------------------------------------------------------------------------
# dictionaries as DataFrames (bounded, safe to broadcast)

def emoji_dim(spark: SparkSession) -> DataFrame:
    """``emoji_dim(code, char, short_names, category)``."""
    return spark.createDataFrame(
        emoji.emoji_rows(),
        "code string, char string, short_names array<string>, category int")


def synonym_table(spark: SparkSession, rows: Synonyms | None = None) -> DataFrame:
    """``synonyms(emoji, word, pos)`` long form."""
    rows = [(e, w, i) for e, ws in (emoji.synonym_rows() if rows is None else rows) for i, w in enumerate(ws)]
    return spark.createDataFrame(rows, "emoji string, word string, pos int")


def token_table(df: DataFrame, id_cols: list[str], tokens: str = "tokens",
                with_synonyms: bool = True, synonym_rows: Synonyms | None = None) -> DataFrame:
    """``(id_cols..., pos, token, synonym)``, the inverted-index rows.

    Synonyms are added by a broadcast join against the bounded dictionary
    (no per-row map lookup and no regrouping shuffle); a synonym row carries
    the position of the emoji it expands.  The documents are read once.
    """
    base = df.select(*id_cols, F.posexplode(tokens).alias("pos", "token"))
    if not with_synonyms:
        return base.withColumn("synonym", F.lit(False))
    words: dict[str, list[str]] = {}
    for e, ws in emoji.synonym_rows() if synonym_rows is None else synonym_rows:
        words.setdefault(e, []).extend(ws)
    syn = F.broadcast(df.sparkSession.createDataFrame(list(words.items()), "_emoji string, _words array<string>"))
    own = F.array(F.struct("token", F.lit(False).alias("synonym")))
    more = F.transform("_words", lambda w: F.struct(w.alias("token"), F.lit(True).alias("synonym")))
    said = F.when(F.col("_words").isNull(), own).otherwise(F.concat(own, more))
    return base.join(syn, F.col("token") == F.col("_emoji"), "left").select(*id_cols, "pos", F.inline(said))


# ---------------------------------------------------------------------------
# shortcodes (X5/X6) and small scalar helpers

def shortcode_to_emoji(text: Column | str, names: emoji.Names | None = None) -> Column:
    """Replace every known ``:name:`` by its character(s); ``names`` adds
    names of a deployment's own (``sources.dictionaries.read_short_names``).

    The text is cut at its colons; from left to right, a part between two that
    are both still there is replaced, with them, if it is a known name."""
    t = F.col(text) if isinstance(text, str) else text
    lut = _literal_map({k[1:-1]: v for k, v in emoji.shortcode_to_char(names).items()})
    parts = F.split(t, ":")
    start = F.struct(F.element_at(parts, 1).alias("out"), F.lit(True).alias("colon"))

    def step(acc, part):
        known = F.when(acc["colon"], F.element_at(lut, part))
        kept = F.concat(acc["out"], F.when(acc["colon"], ":").otherwise(""), part)
        return F.struct(F.coalesce(F.concat(acc["out"], known), kept).alias("out"), known.isNull().alias("colon"))

    inner = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 2, F.lit(0)))
    done = F.aggregate(inner, start, step)
    end = F.concat(done["out"], F.when(done["colon"], ":").otherwise(""), F.element_at(parts, -1))
    return F.when(F.size(parts) > 2, end).otherwise(t)


EMOJI_CHAR_CLASS = "[" + "".join(
    f"\\x{{{lo:X}}}-\\x{{{hi:X}}}" for lo, hi, _ in emoji.EMOJI_BLOCKS) + "]"


def _code_points(chars) -> str:
    return "".join(f"\\x{{{ord(c):X}}}" for c in chars)


def emoji_pattern(names: emoji.Names | None = None) -> tuple[str, str]:
    """A pattern of every known emoji, longer sequences first, and the class of
    characters that one can begin with."""
    known = emoji.char_to_shortcode(names)
    single = {c for c in known if len(c) == 1 and not re.match(EMOJI_PYTHON_CLASS, c)}
    longer = sorted((c for c in known if len(c) > 1), key=lambda c: (-len(c), c))
    alternatives = [_code_points(c) for c in longer] + ["[" + EMOJI_CHAR_CLASS[1:-1] + _code_points(sorted(single)) + "]"]
    first = EMOJI_CHAR_CLASS[1:-1] + _code_points(sorted({c[0] for c in longer} | single))
    return "|".join(alternatives), first


EMOJI_PYTHON_CLASS = "[" + "".join(f"{chr(lo)}-{chr(hi)}" for lo, hi, _ in emoji.EMOJI_BLOCKS) + "]"


def emoji_to_shortcode(text: Column | str, names: emoji.Names | None = None) -> Column:
    """Replace every emoji of the dimension by ``:name:``; of sequences
    (flags, keycaps, those of ``names``) the longest that stands there."""
    t = F.col(text) if isinstance(text, str) else text
    lut = _literal_map(emoji.char_to_shortcode(names))
    known, first = emoji_pattern(names)
    pieces = F.regexp_extract_all(t, F.lit(f"(?s){known}|[^{first}]+|."), 0)
    coded = F.array_join(F.transform(pieces, lambda p: F.coalesce(F.element_at(lut, p), p)), "")
    return F.when(t.rlike(known), coded).otherwise(t)


# fixed values: the search form's time format and the ingest's ISO format
UI_TIME = r"^\s*(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}):(\d{1,2}) ([AaPp][Mm])\s*$"
DATE_TIME = (r"^(\d{4})(?:-(\d{2})(?:-(\d{2}))?)?(?:T(\d{2})(?::(\d{2})(?::(\d{2}(?:\.\d{1,9})?))?)?"
             r"(?:Z|([+-])(\d{2}):?(\d{2})?)?)?$")
EPOCH_MILLIS = r"^-?\d{5,15}$"
ISO_TIME = r"^(\d{4})-(\d{2})-(\d{2})T(\d{2}):(\d{2}):(\d{2}(?:\.\d+)?)Z$"


def _part(t: Column, pattern: str, i: int, typ: str = "int") -> Column:
    return F.regexp_extract(t, pattern, i).try_cast(typ)


def parse_ui_time(text: Column | str) -> Column:
    """``%m/%d/%Y %I:%M %p`` -> timestamp_ntz, wall clock as written (no
    zone conversion); NULL when malformed or not a real date/time."""
    t = F.col(text) if isinstance(text, str) else text
    hour12 = _part(t, UI_TIME, 4)
    pm = F.upper(F.regexp_extract(t, UI_TIME, 6)) == "PM"
    hour = F.when((hour12 >= 1) & (hour12 <= 12), hour12 % 12 + F.when(pm, 12).otherwise(0))
    return F.try_make_timestamp_ntz(_part(t, UI_TIME, 3), _part(t, UI_TIME, 1), _part(t, UI_TIME, 2),
                                    hour, _part(t, UI_TIME, 5), F.lit(0))


def parse_iso_time(text: Column | str) -> Column:
    """ISO 8601 date or date and time, or epoch milliseconds -> timestamp_ntz
    (the UTC wall clock); NULL if it is neither.

    The common form ``yyyy-MM-ddTHH:mm:ss[.f]Z`` is cut at fixed positions
    after one regex; the others (parts left out from the right, offsets, no
    zone) take the slower branch."""
    t = F.col(text) if isinstance(text, str) else text

    def cut(pos: int, n: int, typ: str = "int") -> Column:
        return F.substring(t, pos, n).try_cast(typ)

    secs = t.substr(F.lit(18), F.length(t) - 18).try_cast("decimal(16,6)")
    common = F.try_make_timestamp_ntz(cut(1, 4), cut(6, 2), cut(9, 2), cut(12, 2), cut(15, 2), secs)

    def part(i: int, typ: str, default: int) -> Column:
        got = F.regexp_extract(t, DATE_TIME, i)
        return F.when(got == "", F.lit(default).cast(typ)).otherwise(got.try_cast(typ))

    local = F.try_make_timestamp_ntz(part(1, "int", 1970), part(2, "int", 1), part(3, "int", 1), part(4, "int", 0),
                                     part(5, "int", 0), part(6, "decimal(16,6)", 0))
    sign = F.when(F.regexp_extract(t, DATE_TIME, 7) == "-", -1).otherwise(1)
    offset = F.make_dt_interval(F.lit(0), sign * part(8, "int", 0), sign * part(9, "int", 0), F.lit(0))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), t.try_cast("decimal(18,0)").cast("decimal(21,3)") / 1000)
    return (F.when(t.rlike(ISO_TIME), common).when(t.rlike(DATE_TIME), local - offset)
            .when(t.rlike(EPOCH_MILLIS), epoch))


def relative_size(degree: Column | str, initial: float = 1.0) -> Column:
    """``initial * sqrt(degree)``."""
    d = F.col(degree) if isinstance(degree, str) else degree
    return F.lit(float(initial)) * F.sqrt(d)

"""Analyser dictionaries from files.

Emoticons: one mapping a line, ``a => b`` (an empty ``b`` removes ``a``;
``\\uXXXX`` escapes are read).  Synonyms: ``x, y => z, w`` replaces any of the
left words' expansion by the right ones; a line without ``=>`` makes its first
entry, the emoji, stand for the others.  Short names:
``1f1e8-1f1f3 => cn, china``, with an emoji as hexadecimal code points joined by
``-`` or as it is.  Blank lines and lines that begin with ``# `` are skipped.  A dictionary is small by nature; above ``MAX_ENTRIES``
lines the readers refuse.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions.text import analyze_text

MAX_ENTRIES = 100_000
_ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+")


def _unescape(s: str) -> str:
    def chars(m):
        units = [int(x, 16) for x in m[0].split("\\u")[1:]]
        return b"".join(u.to_bytes(2, "big") for u in units).decode("utf-16-be", "replace")

    return _ESCAPE.sub(chars, s)


def _lines(spark: SparkSession, path: str) -> list[str]:
    rows = (spark.read.text(path).select(F.trim("value").alias("v"))
            .filter((F.col("v") != "") & ~F.col("v").rlike(r"^#(\s|#|$)")).limit(MAX_ENTRIES + 1).collect())
    if len(rows) > MAX_ENTRIES:
        raise ValueError(f"{path}: more than {MAX_ENTRIES} entries are no dictionary")
    return [_unescape(r.v) for r in rows]


def read_emoticons(spark: SparkSession, path: str) -> dict[str, str]:
    """``{emoticon: replacement}``."""
    out = {}
    for line in _lines(spark, path):
        left, arrow, right = line.partition("=>")
        if not arrow or not left.strip():
            raise ValueError(f"{path}: no mapping in {line!r}")
        out[left.strip()] = right.strip()
    return out


_CODES = re.compile(r"[0-9A-Fa-f]{4,6}(-[0-9A-Fa-f]{4,6})*")


def read_short_names(spark: SparkSession, path: str) -> list[tuple[str, list[str]]]:
    """``[(emoji, names)]``; names of several lines add up.  For the ``names``
    of ``text.emoji_to_shortcode`` and ``text.shortcode_to_emoji``."""
    out: dict[str, list[str]] = {}
    for line in _lines(spark, path):
        left, arrow, right = line.partition("=>")
        left, names = left.strip(), [n.strip().strip(":") for n in right.split(",") if n.strip()]
        if not arrow or not left or not names:
            raise ValueError(f"{path}: no names in {line!r}")
        ch = "".join(chr(int(c, 16)) for c in left.split("-")) if _CODES.fullmatch(left) else left
        held = out.setdefault(ch, [])
        held += [n for n in names if n not in held]
    return list(out.items())


def _token(name: str) -> str:
    """An entry as the analyser writes it: an emoji sequence loses joiners,
    selectors and skin tones."""
    tokens = analyze_text(name, {})
    return tokens[0] if len(tokens) == 1 else name


def read_synonyms(spark: SparkSession, path: str) -> list[tuple[str, list[str]]]:
    """``[(token, words)]``; words of several lines add up, without repeats."""
    out: dict[str, list[str]] = {}
    for line in _lines(spark, path):
        left, arrow, right = line.partition("=>")
        names = [w.strip().lower() for w in left.split(",") if w.strip()]
        if not names:
            raise ValueError(f"{path}: no entry in {line!r}")
        words = [w.strip().lower() for w in right.split(",")] if arrow else names[1:]
        for name in names if arrow else names[:1]:
            held = out.setdefault(_token(name), [])
            held += [w for w in words if w and w != name and w not in held]
    return list(out.items())

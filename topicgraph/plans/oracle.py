"""DuckDB SQL twins of the Spark expressions, for the correctness oracles.

The regex character classes are shared with ``functions.text`` (they are
valid in both Java regex and RE2); dictionaries are inlined as literals.
"""

from __future__ import annotations

from ..functions import emoji, text
from ..sources.payments import PAYMENT_LINES_SQL, PAYMENTS_SQL


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def str_list(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]::VARCHAR[]"


def emoticon_map() -> str:
    return "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in emoji.emoticon_chars().items()) + "}"


def analyze(expr: str) -> str:
    """DuckDB twin of ``text.analyze``."""
    emo = q(text.EMOTICON_RE)
    split = (f"string_split_regex(regexp_replace({expr}, {q(text.ZWJ)}, '', 'g'), "
             f"{q(text.WS_CLASS + '+')})")
    emot = (f"list_transform({split}, lambda t: CASE WHEN regexp_extract(t, {emo}, 1) <> '' "
            f"THEN {emoticon_map()}[regexp_extract(t, {emo}, 1)] || regexp_extract(t, {emo}, 2) "
            f"ELSE t END)")
    low = f"list_transform({emot}, lambda t: regexp_replace(lower(t), {q(text.PUNCT_CLASS)}, '', 'g'))"
    return f"list_filter({low}, lambda t: length(t) >= 1)"


def synonyms_values() -> str:
    rows = ", ".join(f"({q(e)}, {str_list(ws)})" for e, ws in emoji.synonym_rows())
    return f"syn(emoji, words) AS (VALUES {rows})"


def syn_map() -> str:
    return "MAP {" + ", ".join(f"{q(e)}: {str_list(ws)}" for e, ws in emoji.synonym_rows()) + "}"


def expanded(tokens: str) -> str:
    """Index-time synonym expansion of a token list (each emoji's words appended)."""
    return (f"list_concat({tokens}, flatten(list_transform({tokens}, "
            f"lambda t: coalesce({syn_map()}[t], []::VARCHAR[]))))")


def ts(expr: str) -> str:
    """Timestamp rendered like Spark's ``date_format(..., 'yyyy-MM-dd HH:mm:ss')``."""
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def payments_cte() -> str:
    return f"payments AS ({PAYMENTS_SQL})"


def payment_lines_cte() -> str:
    return f"payment_lines AS ({PAYMENT_LINES_SQL})"

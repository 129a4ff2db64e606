"""Emoji dictionaries: emoticons, short names, synonyms, the emoji dimension.

The emoticon table and the short names of the emoji it points to are fixed
values.  The emoji dimension (about 1,700 code points) is built from a rule:
every named code point of six Unicode emoji blocks, its short name and
synonym words taken from its Unicode character name.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

# ---------------------------------------------------------------------------
# fixed values: emoticon -> emoji short name (46 entries, in this order)
EMOTICONS = [
    ("<3", "heart"),
    ("</3", "broken_heart"),
    (":)", "blush"),
    ("(:", "blush"),
    (":-)", "blush"),
    ("C:", "smile"),
    ("c:", "smile"),
    (":D", "smile"),
    (":-D", "smile"),
    (";)", "wink"),
    (";-)", "wink"),
    ("):", "disappointed"),
    (":(", "disappointed"),
    (":-(", "disappointed"),
    (":'(", "cry"),
    ("=)", "smiley"),
    ("=-)", "smiley"),
    (":*", "kiss"),
    (":-*", "kiss"),
    (":>", "laughing"),
    (":->", "laughing"),
    ("8)", "sunglasses"),
    (":\\\\", "confused"),
    (":-\\\\", "confused"),
    (":/", "confused"),
    (":-/", "confused"),
    (":|", "neutral_face"),
    (":-|", "neutral_face"),
    (":o", "open_mouth"),
    (":-o", "open_mouth"),
    (">:(", "angry"),
    (">:-(", "angry"),
    (":p", "stuck_out_tongue"),
    (":-p", "stuck_out_tongue"),
    (":P", "stuck_out_tongue"),
    (":-P", "stuck_out_tongue"),
    (":b", "stuck_out_tongue"),
    (":-b", "stuck_out_tongue"),
    (";p", "stuck_out_tongue_winking_eye"),
    (";-p", "stuck_out_tongue_winking_eye"),
    (";b", "stuck_out_tongue_winking_eye"),
    (";-b", "stuck_out_tongue_winking_eye"),
    (";P", "stuck_out_tongue_winking_eye"),
    (";-P", "stuck_out_tongue_winking_eye"),
    (":o)", "monkey_face"),
    ("D:", "anguished"),
]

# fixed values: short name -> code point of the emoji the emoticons name
SHORT_NAME_CODES = {
    "heart": 0x2764,
    "broken_heart": 0x1F494,
    "blush": 0x1F60A,
    "smile": 0x1F604,
    "wink": 0x1F609,
    "disappointed": 0x1F61E,
    "cry": 0x1F622,
    "smiley": 0x1F603,
    "kiss": 0x1F48B,
    "laughing": 0x1F606,
    "sunglasses": 0x1F60E,
    "confused": 0x1F615,
    "neutral_face": 0x1F610,
    "open_mouth": 0x1F62E,
    "angry": 0x1F620,
    "stuck_out_tongue": 0x1F61B,
    "stuck_out_tongue_winking_eye": 0x1F61C,
    "monkey_face": 0x1F435,
    "anguished": 0x1F627,
}

# fixed values: emoji blocks of the dimension and their category number
EMOJI_BLOCKS = [
    (0x1F600, 0x1F64F, 0),  # emoticons
    (0x1F900, 0x1F9FF, 0),  # supplemental symbols and pictographs
    (0x2600, 0x26FF, 1),    # miscellaneous symbols
    (0x1F300, 0x1F5FF, 2),  # miscellaneous symbols and pictographs
    (0x1F680, 0x1F6FF, 3),  # transport and map symbols
    (0x2700, 0x27BF, 4),    # dingbats
]

# fixed values: flags that have a short name (that of their two letters), other
# names of a flag, and the name of the one keycap that is no digit
FLAGS = ("cn", "de", "es", "fr", "gb", "it", "jp", "kr", "ru", "us")
FLAG_ALIASES = {"gb": "uk"}
KEYCAP_NAMES = {"#": "hash"}
FLAG_CATEGORY, KEYCAP_CATEGORY = 3, 4
KEYCAP, VARIATION, REGIONAL_A = "\u20e3", "\ufe0f", 0x1F1E6

# fixed values: skin tone modifiers (removed by the analyser, not emoji)
SKIN_TONES = (0x1F3FB, 0x1F3FC, 0x1F3FD, 0x1F3FE, 0x1F3FF)

# fixed values: name words never used as synonyms
STOP_WORDS = ("with", "of", "and", "the", "in", "on", "for", "a", "an", "to")


def _name_words(name: str) -> list[str]:
    words = []
    for w in name.lower().replace("-", " ").split():
        if w not in STOP_WORDS and w not in words:
            words.append(w)
    return words


@lru_cache(maxsize=1)
def emoji_rows() -> list[tuple[str, str, list[str], int]]:
    """``(code, char, short_names, category)`` for every emoji of the blocks."""
    alias = {}
    for short, cp in SHORT_NAME_CODES.items():
        alias.setdefault(cp, []).append(short)
    rows = []
    for lo, hi, cat in EMOJI_BLOCKS:
        for cp in range(lo, hi + 1):
            if cp in SKIN_TONES:
                continue
            name = unicodedata.name(chr(cp), None)
            if not name:
                continue
            derived = name.lower().replace("-", "_").replace(" ", "_")
            shorts = alias.get(cp, []) + ([derived] if derived not in alias.get(cp, []) else [])
            rows.append((f"{cp:04x}", chr(cp), shorts, cat))
    return rows


@lru_cache(maxsize=1)
def sequence_rows() -> list[tuple[str, str, list[str], int]]:
    """``(code, chars, short_names, category)`` of the emoji that are more than
    one character: flags are two regional letters, keycaps a key and U+20E3
    (a digit's name is that of its Unicode character)."""
    rows = []
    for key in "#0123456789":
        name = KEYCAP_NAMES.get(key) or unicodedata.name(key).lower().removeprefix("digit ")
        rows.append((f"{ord(key):04x}-20e3", key + KEYCAP, [name], KEYCAP_CATEGORY))
    for flag in FLAGS:
        letters = [REGIONAL_A + ord(c) - ord("a") for c in flag]
        names = [flag] + ([FLAG_ALIASES[flag]] if flag in FLAG_ALIASES else [])
        rows.append(("-".join(f"{c:04x}" for c in letters), "".join(map(chr, letters)), names, FLAG_CATEGORY))
    return rows


@lru_cache(maxsize=1)
def synonym_rows() -> list[tuple[str, list[str]]]:
    """``(emoji, words)``: words of the Unicode name plus alias short names."""
    out = []
    for _code, ch, shorts, _cat in emoji_rows():
        words = _name_words(unicodedata.name(ch))
        for s in shorts[:-1]:           # aliases (the derived name repeats the words)
            for w in s.split("_"):
                if w not in STOP_WORDS and w not in words:
                    words.append(w)
        out.append((ch, words))
    return out


@lru_cache(maxsize=1)
def emoticon_chars() -> dict[str, str]:
    """Emoticon -> emoji character."""
    return {emo: chr(SHORT_NAME_CODES[short]) for emo, short in EMOTICONS}


Names = list[tuple[str, list[str]]]


def _named(names: Names | None) -> Names:
    """A deployment's own names first, then those of the dimension."""
    return list(names or []) + [(ch, shorts) for _code, ch, shorts, _cat in sequence_rows() + emoji_rows()]


def shortcode_to_char(names: Names | None = None) -> dict[str, str]:
    """``:name:`` -> character (or characters) for every short name."""
    out: dict[str, str] = {}
    for ch, shorts in _named(names):
        for s in shorts:
            out.setdefault(f":{s}:", ch)
    return out


def char_to_shortcode(names: Names | None = None) -> dict[str, str]:
    """Character (or characters) -> its first short name as ``:name:``.  A
    keycap may have a variation selector inside."""
    out: dict[str, str] = {}
    for ch, shorts in _named(names):
        if shorts:
            out.setdefault(ch, f":{shorts[0]}:")
            if ch.endswith(KEYCAP) and VARIATION not in ch:
                out.setdefault(ch[:-1] + VARIATION + KEYCAP, f":{shorts[0]}:")
    return out


def as_json(d: dict) -> str:
    return json.dumps(d, ensure_ascii=False)

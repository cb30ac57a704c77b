"""Flags, blank filter, score and label on hand-made edge rows."""

from keysieve.functions.charclass import FLAG_COLUMNS
from keysieve.operators import features

EDGE = ['a"b', "a\\b", "a-b", "a|b", "é1", "a b", "a\x0bb", "abcdefgh", "abcdefghi",
        "é", "a", "aB", "aB1", "aB1!", "Password1!", "ABC", "123", "abc"]


def _rows(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "password string")
    out = features.label(df).collect()
    return {r["password"]: r for r in out}


def test_symbol_vs_special(spark):
    r = _rows(spark, EDGE)
    # '"' and '\' are symbols but not in the special set; '-' and '|' are both.
    assert (r['a"b']["has_symbols"], r['a"b']["has_special_characters"]) == (1, 0)
    assert (r["a\\b"]["has_symbols"], r["a\\b"]["has_special_characters"]) == (1, 0)
    assert (r["a-b"]["has_symbols"], r["a-b"]["has_special_characters"]) == (1, 1)
    assert (r["a|b"]["has_symbols"], r["a|b"]["has_special_characters"]) == (1, 1)
    # é is a symbol and no ASCII letter.
    assert r["é1"]["has_symbols"] == 1 and r["é1"]["has_lower"] == 0
    assert r["é1"]["has_letter_and_digit"] == 0


def test_spaces_include_vertical_tab(spark):
    r = _rows(spark, EDGE)
    assert r["a b"]["has_spaces"] == 1
    assert r["a\x0bb"]["has_spaces"] == 1


def test_whole_string_classes(spark):
    r = _rows(spark, EDGE)
    assert (r["ABC"]["is_upper"], r["ABC"]["is_lower"], r["ABC"]["is_digit"]) == (1, 0, 0)
    assert (r["123"]["is_digit"], r["abc"]["is_lower"]) == (1, 1)
    assert r["aB1"]["has_letter_and_digit"] == 1


def test_score_and_label(spark):
    r = _rows(spark, EDGE)
    expect = {"é": (0, "weak"), "a": (1, "weak"), "aB": (2, "weak"), "aB1": (3, "medium"),
              "aB1!": (4, "medium"), "Password1!": (5, "Strong")}
    for pw, (score, label) in expect.items():
        assert (r[pw]["score"], r[pw]["password_strength"]) == (score, label), pw
    # length bonus starts above 8 characters
    assert r["abcdefgh"]["score"] == 1 and r["abcdefghi"]["score"] == 2


def test_flags_are_int(spark):
    df = features.label(spark.createDataFrame([("x",)], "password string"))
    types = dict(df.dtypes)
    assert all(types[c] == "int" for c in FLAG_COLUMNS + ["length", "score"])


def test_blank_and_long_filters(spark):
    vals = [None, "", "  ", "\t", "ok", "x" * 19, "x" * 20, "x" * 21]
    df = spark.createDataFrame([(v,) for v in vals], "password string")
    kept = sorted(r[0] for r in features.clean(df).collect())
    assert kept == sorted(["ok", "x" * 19])
    assert features.drop_blank(df).count() == 4


def test_frequency_band(spark):
    df = spark.createDataFrame([(9,), (10,), (0,), (None,)], "breach_count int")
    bands = {r["breach_count"]: r["common_or_rare"]
             for r in features.with_frequency_band(df).collect()}
    assert bands == {9: "rare", 10: "common", 0: "rare", None: "rare"}

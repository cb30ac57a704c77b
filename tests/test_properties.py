"""Brute-force checks: Spark expressions against plain-Python definitions on
generated strings (hypothesis), including non-ASCII and control characters."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from keysieve.functions import charclass as cc
from keysieve.functions import sequence
from keysieve.functions.text import py_strip
from keysieve.operators import features

ALPHABET = st.sampled_from(list("aZ09 !\"\\-|~é\t\x0b\x0cÄß?_[]{}';,./<>@#$%^&*()+=`:"))
STRINGS = st.lists(st.text(alphabet=ALPHABET, min_size=0, max_size=24), min_size=1, max_size=60)

SPECIAL = set("!@#$%^&*()_+{}|:<>?~`-=[];',./")


def py_flags(p: str) -> dict:
    letters = [c for c in p if c.isascii() and c.isalpha()]
    digits = [c for c in p if c in "0123456789"]
    f = {
        "is_lower": int(bool(p) and all("a" <= c <= "z" for c in p)),
        "is_upper": int(bool(p) and all("A" <= c <= "Z" for c in p)),
        "is_digit": int(bool(p) and all("0" <= c <= "9" for c in p)),
        "has_letter_and_digit": int(bool(letters) and bool(digits)),
        "has_digits": int(bool(digits)),
        "has_upper": int(any("A" <= c <= "Z" for c in p)),
        "has_lower": int(any("a" <= c <= "z" for c in p)),
        "has_symbols": int(any(not (c.isascii() and c.isalnum()) for c in p)),
        "has_spaces": int(any(c in " \t\n\x0b\x0c\r" for c in p)),
        "has_special_characters": int(any(c in SPECIAL for c in p)),
        "length": len(p),
    }
    score = (f["has_upper"] + f["has_lower"] + f["has_digits"] + f["has_special_characters"]
             + int(len(p) > 8))
    f["score"] = score
    f["password_strength"] = "Strong" if score == 5 else ("medium" if score >= 3 else "weak")
    return f


VOCAB = {c: i + 1 for i, c in enumerate(sequence.VOCABULARY)}


def py_encode(p):
    p = (p or "").lower()[:20]
    return [VOCAB.get(c, 0) for c in p] + [0] * (20 - len(p))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=STRINGS)
def test_flags_match_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "password string")
    for r in features.label(df).collect():
        exp = py_flags(r["password"])
        got = {k: r[k] for k in exp}
        assert got == exp, r["password"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=STRINGS)
def test_blank_filter_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "password string")
    got = sorted(r[0] for r in features.drop_blank(df).collect())
    exp = sorted(v for v in values if not re.fullmatch(r"[ \t\n\x0b\x0c\r]*", v))
    assert got == exp


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=STRINGS)
def test_encoder_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "password string")
    for r in df.select("password", sequence.encode("password").alias("e")).collect():
        assert r["e"] == py_encode(r["password"])


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.text(min_size=0, max_size=12), min_size=1, max_size=40))
def test_strip_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(py_strip("v")).collect()]
    assert got == [v.strip() for v in values]


def test_label_constants():
    assert cc.CLASS_ORDER == ["weak", "medium", "Strong"]

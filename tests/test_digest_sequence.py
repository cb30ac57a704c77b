"""SHA-1 digest, range split, charset handling and the sequence encoder."""

import re

from pyspark.sql import functions as F

from keysieve.functions import digest, sequence
from keysieve.operators import breach


def test_sha1_known_value(spark):
    df = breach.with_digest(spark.createDataFrame([("password",)], "password string"))
    r = df.first()
    assert r["sha1"] == "5BAA61E4C9B93F3F0682250B6CF8331B7EE68FD8"
    assert r["prefix"] == "5BAA6" and r["suffix"] == "1E4C9B93F3F0682250B6CF8331B7EE68FD8"
    assert len(r["suffix"]) == 35 and re.fullmatch("[0-9A-F]{40}", r["sha1"])


def test_latin1_bytes_hash_like_original_utf8(spark):
    # "pé" in UTF-8 is 70 C3 A9; read as latin-1 it is the string "pÃ©".
    mis = bytes([0x70, 0xC3, 0xA9]).decode("latin-1")
    df = spark.createDataFrame([(mis, "pé")], "a string, b string")
    r = df.select(digest.sha1_hex("a", charset="ISO-8859-1").alias("x"),
                  digest.sha1_hex("b").alias("y")).first()
    assert r["x"] == r["y"]


def _enc(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "password string")
    return [r[0] for r in df.select(sequence.encode("password")).collect()]


def test_encoder_edges(spark):
    empty, upper, lower, q, space, quote, tilde, long_, null = _enc(
        spark, ["", "A", "a", "?", " ", '"', "~", "abcdefghijklmnopqrstu", None])
    assert empty == [0] * 20 and null == [0] * 20
    assert upper == lower == [1] + [0] * 19
    assert q[0] == 64
    assert space[0] == quote[0] == tilde[0] == 0
    assert len(long_) == 20 and long_[-1] == 20  # cut at 20 characters ('t')


def test_encoder_range_and_width(spark):
    vals = _enc(spark, ["Password1!", "x" * 30, "!@#$%^&*()_+-=[]{}|;:',.<>/?"])
    for v in vals:
        assert len(v) == 20 and all(0 <= x <= 64 for x in v)


def test_hash_bits_range(spark):
    df = spark.range(1000).select(digest.hash_bits(F.col("id"), "s").alias("b"))
    r = df.agg(F.min("b"), F.max("b")).first()
    assert 0 <= r[0] and r[1] < 2 ** 32


def test_encoder_unknown_id_and_cased(spark):
    df = spark.createDataFrame([("a B~",)], "password string")
    r = df.select(sequence.encode("password", unknown_id=sequence.VOCAB_SIZE).alias("u"),
                  sequence.encode("password", cased=True, unknown_id=99).alias("c"),
                  sequence.encode("password").alias("d")).first()
    # 'a'=1, ' '=unknown, 'b'=2, '~'=unknown, then padding 0
    assert r["u"][:5] == [1, 65, 2, 65, 0]
    assert r["c"][:5] == [1, 99, 99, 99, 0]  # upper-case B is outside the vocabulary when cased
    assert r["d"][:5] == [1, 0, 2, 0, 0]

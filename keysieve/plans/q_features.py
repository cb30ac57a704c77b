"""Queries: cleaning filters, flags, score, label, digest, sequence encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from keysieve.functions import ngrams, sequence, sql_surface
from keysieve.functions.charclass import FLAG_COLUMNS
from keysieve.operators import breach, features
from keysieve.plans.oracle import FEATURE_NAMES, encode_sql, md5_bits, sql
from keysieve.plans.registry import query
from keysieve.sources import tables as T


@query("drop_blank", sql("SELECT password FROM nonblank"))
def drop_blank(spark, d):
    return features.drop_blank(T.raw(spark, d))


@query("drop_long", sql("SELECT password FROM clean"))
def drop_long(spark, d):
    return features.clean(T.raw(spark, d))


@query("char_class_features",
       sql(f"SELECT password, freq, {FEATURE_NAMES} FROM feats"))
def char_class_features(spark, d):
    return features.with_features(T.candidates(spark, d)).select(
        "password", "freq", *FLAG_COLUMNS, "length")


@query("strength_score", sql("SELECT password, score FROM scored"))
def strength_score(spark, d):
    return features.with_score(features.with_features(T.candidates(spark, d))).select(
        "password", "score")


@query("strength_label",
       sql("SELECT password, score, password_strength FROM labelled"))
def strength_label(spark, d):
    return T.labelled(spark, d).select("password", "score", "password_strength")


@query("sha1_digest", sql("SELECT password, upper(sha1(password)) AS sha1 FROM candidates"))
def sha1_digest(spark, d):
    return breach.with_digest(T.candidates(spark, d)).select("password", "sha1")


@query("sha1_range_split",
       sql("SELECT password, sha1, prefix, suffix FROM digested"))
def sha1_range_split(spark, d):
    return breach.with_digest(T.candidates(spark, d)).select("password", "sha1", "prefix", "suffix")


@query("sequence_encode",
       sql(f"SELECT password, {encode_sql('password')} AS encoded_pass FROM candidates"))
def sequence_encode(spark, d):
    return T.candidates(spark, d).select("password",
                                         sequence.encode("password").alias("encoded_pass"))


@query("drop_plaintext",
       sql(f"SELECT {encode_sql('password')} AS encoded_pass, password_strength FROM labelled"))
def drop_plaintext(spark, d):
    """Training rows for the sequence model: encoding and label, no plaintext."""
    return (T.labelled(spark, d)
            .withColumn("encoded_pass", sequence.encode("password"))
            .select("encoded_pass", "password_strength"))


def _sql_over_candidates(spark, d, text):
    """``text``, a query in Spark SQL over the view ``pw_candidates``."""
    sql_surface.register(spark)
    T.candidates(spark, d).createOrReplaceTempView("pw_candidates")
    return spark.sql(text)


@query("strength_label_sql", sql("SELECT password, score, password_strength FROM labelled"))
def strength_label_sql(spark, d):
    """The rows of ``strength_label`` by a query in SQL text."""
    return _sql_over_candidates(spark, d, """
        SELECT password, pw_score(password) AS score, pw_strength(password) AS password_strength FROM pw_candidates""")


@query("sql_functions", sql(f"""
SELECT password, {FEATURE_NAMES.rsplit(',', 1)[0]}, sha1, prefix, suffix, {encode_sql('password')} AS encoded_pass
FROM digested WHERE score >= 3"""))
def sql_functions(spark, d):
    """Flags, digest parts and encoding of the medium and strong candidates, in SQL text."""
    flags = ", ".join(f"pw_{c}(password) AS {c}" for c in FLAG_COLUMNS)
    return _sql_over_candidates(spark, d, f"""
        SELECT password, {flags}, pw_sha1(password) AS sha1, pw_range_prefix(password) AS prefix,
               pw_range_suffix(password) AS suffix, pw_encode(password) AS encoded_pass
        FROM pw_candidates WHERE pw_strength(password) <> 'weak'""")


@query("hashed_ngrams", sql(f"""
SELECT password, count(*) AS grams, count(DISTINCT bucket) AS buckets, sum(bucket)::BIGINT AS bucket_sum
FROM (SELECT password, {md5_bits('substr(s, i, n)', ngrams.SALT)} % {ngrams.BUCKETS} AS bucket
      FROM (SELECT password, chr(2) || lower(password) || chr(3) AS s, unnest([1, 2, 3]) AS n FROM candidates),
           LATERAL (SELECT unnest(range(1, length(s) - n + 2)) AS i))
GROUP BY password"""))
def hashed_ngrams(spark, d):
    """Buckets of each candidate's character n-grams: their number, distinct ones and sum."""
    b = T.candidates(spark, d).select("password", ngrams.buckets("password").alias("b"))
    return b.select("password", F.size("b").cast("bigint").alias("grams"), F.size(F.array_distinct("b")).cast("bigint").alias("buckets"),
                    F.aggregate("b", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("bucket_sum"))

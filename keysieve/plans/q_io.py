"""Queries: word-list scan, CSV and Parquet round trips, staged outputs and
partitioned parts (all written under the session's checkpoint dir)."""

from __future__ import annotations

from pyspark.sql import functions as F

from keysieve.config import scratch_path
from keysieve.functions import charclass as cc
from keysieve.functions.text import sql_char_set
from keysieve.operators import audit
from keysieve.operators import breach as B
from keysieve.operators import sampling as S
from keysieve.plans.oracle import FLAG_LIST, SPACE, TOKENS, md5_bits, py_strip_sql, sql
from keysieve.plans.registry import query
from keysieve.sources import breach as breach_src
from keysieve.sources import io
from keysieve.sources import tables as T
from keysieve.sources import wordlist

PARTS = 10
LABEL_COLS = ["password", "freq", "length", "score", "password_strength"]


@query("wordlist_scan", sql(
    f"SELECT {py_strip_sql('tok')} AS password FROM (SELECT {TOKENS} AS tok FROM documents)"))
def wordlist_scan(spark, d):
    """Write document tokens one per line, then scan them as a word list."""
    path = scratch_path(spark, "wordlist")
    wordlist.write_wordlist(T.text_tokens(spark, d, "documents"), path)
    return wordlist.read_wordlist(spark, path, charset="UTF-8").select("password")


@query("wordlist_latin1_match", sql(f"""
SELECT upper(sha1(tok)) AS sha1, count(*) AS freq, max(breach_count) AS breach_count
FROM (SELECT trim(tok, {sql_char_set("".join(map(chr, (9, 10, 11, 12, 13, 32))))}) AS tok
      FROM (SELECT {TOKENS} AS tok FROM documents)) t
JOIN breach b ON b.prefix || b.suffix = upper(sha1(tok)) GROUP BY 1"""))
def wordlist_latin1_match(spark, d):
    """Document tokens (with multi-byte letters) written as a word list, read
    as latin-1 and matched by their own bytes."""
    path = scratch_path(spark, "wordlist")
    wordlist.write_wordlist(T.text_tokens(spark, d, "documents"), path)
    words = wordlist.read_wordlist(spark, path).groupBy(B.BYTES).agg(F.count(F.lit(1)).alias("freq"))
    return B.match_breach(words, T.breach(spark, d)).select("sha1", "freq", "breach_count")


@query("csv_roundtrip", sql("SELECT DEST_COUNTRY_NAME, count FROM flights"))
def csv_roundtrip(spark, d):
    path = scratch_path(spark, "flights-csv")
    io.write_csv(T.flights(spark, d), path)
    return io.read_csv(spark, path)


@query("parquet_roundtrip", sql(f"SELECT {', '.join(LABEL_COLS)} FROM labelled"))
def parquet_roundtrip(spark, d):
    path = scratch_path(spark, "labelled")
    io.write_parquet(T.labelled(spark, d).select(*LABEL_COLS), path)
    return io.read_parquet(spark, path)


@query("stage_checkpoint", sql(f"SELECT {', '.join(LABEL_COLS)} FROM labelled"))
def stage_checkpoint(spark, d):
    """Build once, then reuse the finished table: the second call's builder
    would give no rows, so the result shows that it was not run."""
    path = scratch_path(spark, "stage")
    lab = T.labelled(spark, d).select(*LABEL_COLS)
    io.stage(spark, path, lambda: lab)
    return io.stage(spark, path, lambda: lab.limit(0))


@query("split_parts", sql(f"""
SELECT ({md5_bits('password', S.SALT_PARTS)} % {PARTS})::INT AS split_id, count(*) AS n
FROM labelled GROUP BY 1"""))
def split_parts(spark, d):
    """Ten deterministic parts written as ``split_id=k`` directories in one job."""
    path = scratch_path(spark, "parts")
    io.write_parts(T.labelled(spark, d).select(*LABEL_COLS), path, PARTS)
    return (spark.read.parquet(path).groupBy("split_id")
            .agg(F.count(F.lit(1)).alias("n")))


_AUDIT_SQL = sql(f"""
SELECT a.password, upper(sha1(a.password)) AS sha1, a.freq, {', '.join(audit.AUDIT_COLUMNS[3:15])}, a.password_strength,
       coalesce(b.breach_count, 0) AS breach_count, (b.breach_count IS NOT NULL)::INT AS exposed,
       CASE WHEN coalesce(b.breach_count, 0) >= 10 THEN 'common' ELSE 'rare' END AS common_or_rare
FROM wlab a LEFT JOIN breach b
  ON substr(upper(sha1(a.password)), 1, 5) = b.prefix
 AND substr(upper(sha1(a.password)), 6, 35) = b.suffix""", f"""
wl AS (SELECT {py_strip_sql('tok')} AS password FROM (SELECT {TOKENS} AS tok FROM documents)),
wcand AS (
  SELECT password, count(*) AS freq FROM wl
  WHERE NOT regexp_matches(password, '^{SPACE}*$') AND length(password) < 20 GROUP BY 1),
wfeat AS (SELECT password, freq, {FLAG_LIST}, length(password)::INT AS length FROM wcand),
wscore AS (
  SELECT *, (has_upper + has_lower + has_digits + has_special_characters
             + CASE WHEN length > 8 THEN 1 ELSE 0 END)::INT AS score FROM wfeat),
wlab AS (
  SELECT *, CASE WHEN score = 5 THEN 'Strong' WHEN score >= 3 THEN 'medium' ELSE 'weak' END
         AS password_strength FROM wscore)""")


@query("wordlist_audit", _AUDIT_SQL)
def wordlist_audit(spark, d):
    """The whole audit from files: document tokens as a word list, the corpus
    as ``SHA1:COUNT`` lines, one job writing the audited table."""
    wl = scratch_path(spark, "audit-wordlist")
    corpus = scratch_path(spark, "audit-corpus")
    wordlist.write_wordlist(T.text_tokens(spark, d, "documents"), wl)
    breach_src.write_breach_hashes(T.breach(spark, d), corpus)
    return audit.audit_wordlist(spark, wl, corpus, scratch_path(spark, "audit-out"),
                                charset="UTF-8", keep_plaintext=True, max_length=cc.MAX_LENGTH_EXCLUSIVE)

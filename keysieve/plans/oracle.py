"""DuckDB twins of the fixture frames (see FIXTURES.md) for oracle SQL.

RE2 has no look-ahead and its ``\\s`` lacks VT, so the flags are spelled out:
``has_letter_and_digit`` is the conjunction and the blank/space classes list
``[ \\t\\n\\x0B\\f\\r]``. Counts are BIGINT, flags INT, ratios rounded to 6.
"""

from __future__ import annotations

from keysieve.functions.sequence import VOCABULARY, WIDTH
from keysieve.functions.text import PY_WHITESPACE, sql_char_set

SPACE = r"[ \t\n\x0B\f\r]"
SPECIAL = r"[!@#$%^&*()_+{}\|:<>?~`\-=\[\];'',./]"  # '' is a quote inside SQL

FLAGS_SQL = {
    "is_lower": "regexp_matches(password, '^[a-z]+$')::INT",
    "is_upper": "regexp_matches(password, '^[A-Z]+$')::INT",
    "is_digit": "regexp_matches(password, '^[0-9]+$')::INT",
    "has_letter_and_digit": "(regexp_matches(password, '[a-zA-Z]') AND regexp_matches(password, '[0-9]'))::INT",
    "has_digits": "regexp_matches(password, '[0-9]')::INT",
    "has_upper": "regexp_matches(password, '[A-Z]')::INT",
    "has_lower": "regexp_matches(password, '[a-z]')::INT",
    "has_symbols": "regexp_matches(password, '[^a-zA-Z0-9]')::INT",
    "has_spaces": f"regexp_matches(password, '{SPACE}')::INT",
    "has_special_characters": f"regexp_matches(password, '{SPECIAL}')::INT",
}
FLAG_LIST = ", ".join(f"{v} AS {k}" for k, v in FLAGS_SQL.items())
FLAG_NAMES = ", ".join(FLAGS_SQL)
FEATURE_NAMES = FLAG_NAMES + ", length"
TOKENS = r"unnest(string_split_regex(text, '[ \t\n\r]+'))"


def md5_bits(key: str, salt: str) -> str:
    return f"('0x' || substr(md5(({key})::VARCHAR || '|{salt}'), 1, 8))::BIGINT"


def encode_sql(col: str = "password", width: int = WIDTH) -> str:
    vocab = VOCABULARY.replace("'", "''")
    s = f"lower(coalesce({col}, ''))"
    return (f"list_transform(range(1, {width + 1}), lambda i: CASE WHEN i <= length({s}) "
            f"THEN strpos('{vocab}', substr({s}, i, 1)) ELSE 0 END)::INTEGER[]")


def py_strip_sql(col: str) -> str:
    return f"trim({col}, {sql_char_set(PY_WHITESPACE)})"


BASE_CTES = f"""
raw AS (
  SELECT {TOKENS} AS password FROM documents
  UNION ALL SELECT c_name FROM customer
  UNION ALL SELECT c_mktsegment FROM customer
  UNION ALL SELECT p_brand FROM part),
nonblank AS (
  SELECT password FROM raw WHERE NOT regexp_matches(password, '^{SPACE}*$')),
clean AS (
  SELECT password FROM nonblank WHERE length(password) < 20),
candidates AS (
  SELECT password, count(*) AS freq FROM clean GROUP BY password),
feats AS (
  SELECT password, freq, {FLAG_LIST}, length(password)::INT AS length FROM candidates),
scored AS (
  SELECT *, (has_upper + has_lower + has_digits + has_special_characters
             + CASE WHEN length > 8 THEN 1 ELSE 0 END)::INT AS score FROM feats),
labelled AS (
  SELECT *, CASE WHEN score = 5 THEN 'Strong' WHEN score >= 3 THEN 'medium' ELSE 'weak' END
         AS password_strength FROM scored),
bsrc AS (
  SELECT {TOKENS} AS p, 1 AS k FROM conversations
  UNION ALL SELECT {TOKENS}, 1 FROM benchmark
  UNION ALL SELECT c.c_name, o.n FROM customer c
            JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) o
            ON c.c_custkey = o.o_custkey),
breach AS (
  SELECT substr(upper(sha1(p)), 1, 5) AS prefix, substr(upper(sha1(p)), 6, 35) AS suffix,
         sum(k)::BIGINT AS breach_count
  FROM bsrc WHERE p <> '' GROUP BY 1, 2),
digested AS (
  SELECT *, upper(sha1(password)) AS sha1, substr(upper(sha1(password)), 1, 5) AS prefix,
         substr(upper(sha1(password)), 6, 35) AS suffix FROM labelled),
matched AS (
  SELECT d.*, b.breach_count FROM digested d
  JOIN breach b ON d.prefix = b.prefix AND d.suffix = b.suffix),
exposure AS (
  SELECT d.*, coalesce(b.breach_count, 0) AS breach_count,
         (b.breach_count IS NOT NULL)::INT AS exposed FROM digested d
  LEFT JOIN breach b ON d.prefix = b.prefix AND d.suffix = b.suffix),
flights AS (
  SELECT n_name AS DEST_COUNTRY_NAME, count(*) AS count
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, c_mktsegment),
ruled AS (
  SELECT *, password_strength AS true_label,
         CASE WHEN length < 8 THEN 'weak' WHEN length < 12 THEN 'medium' ELSE 'Strong' END
         AS predicted_label FROM labelled),
cells AS (
  SELECT true_label, predicted_label, count(*) AS n FROM ruled GROUP BY 1, 2)
"""


def sql(body: str, extra_ctes: str = "") -> str:
    """Full statement: the fixture CTEs, optional extra CTEs, then ``body``."""
    ctes = BASE_CTES.rstrip()
    if extra_ctes.strip():
        ctes += ",\n" + extra_ctes.strip().rstrip(",")
    return f"WITH {ctes.strip()}\n{body.strip()}"

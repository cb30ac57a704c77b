"""The registered queries: one per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from keysieve.llm import (chat, decontam, exact_dedup, fingerprints, lm_score, packing, simhash, spelling, suffix_dedup,
                          token_counts, toxicity, url_filter, vector_codes)
from keysieve.llm.common import table
from keysieve.llm.registry import query

#: Rules of op5: (verdict, host, path).
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))


@query("op1_decontamination", r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark),
its AS (SELECT DISTINCT item_id, least(len(w), 5) AS k, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
       lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM iw WHERE len(w) > 0),
ds AS (SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2),
       lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s FROM dw, (SELECT DISTINCT k FROM its) WHERE len(w) >= k),
size AS (SELECT item_id, count(*)::INT AS n_shingles FROM its GROUP BY item_id),
hit AS (SELECT doc_id, item_id, count(*)::INT AS shared FROM ds JOIN its USING (k, s) GROUP BY 1, 2)
SELECT doc_id, item_id, shared, n_shingles, shared / n_shingles AS containment
FROM hit JOIN size USING (item_id) WHERE shared >= 0.8 * n_shingles - 1e-9""")
def op1(spark, d):
    return decontam.contained(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query("op2_chat_formatting", r"""
WITH t AS (SELECT DISTINCT conv_id, CASE WHEN conv_id IS NOT NULL THEN turn END AS turn,
             coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations),
c AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY turn, role, text) AS turns, count(*)::INT AS n_turns
      FROM t GROUP BY conv_id, CASE WHEN conv_id IS NULL THEN {'r': role, 't': text} END),
p AS (SELECT DISTINCT i.n AS n_turns, c.turns[1:i.n] AS turns
      FROM c, LATERAL (SELECT unnest(range(1, c.n_turns)) AS n) i),
u AS (SELECT min(conv_id) AS conv_id, count(*) AS n_copies, n_turns, turns FROM c GROUP BY n_turns, turns)
SELECT conv_id, n_turns, n_copies, array_to_string(list_transform(turns, lambda x:
  '<|im_start|>' || replace(x.r, '<|', '< |') || chr(10) || replace(x.t, '<|', '< |') || '<|im_end|>' || chr(10)), '')
  AS rendered
FROM u WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.n_turns = u.n_turns AND p.turns = u.turns)""")
def op2(spark, d):
    return chat.format_chats(table(spark, d, "conversations"))


@query("op3_token_counts")
def op3(spark, d):
    return token_counts.token_counts(table(spark, d, "documents"))


@query("op4_best_fit_packing")
def op4(spark, d):
    return packing.pack_documents(table(spark, d, "documents"))


@query("op5_url_filters", r"""
WITH rules(verdict, rh, rp) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
u AS (SELECT row_number() OVER () AS k, page_id,
  coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
j AS (SELECT u.*, rh || rp AS rule, verdict, row_number() OVER (
        PARTITION BY k ORDER BY length(rh || rp) DESC NULLS LAST, length(rh) DESC) AS rn
      FROM u LEFT JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM j WHERE rn = 1""")
def op5(spark, d):
    return url_filter.filter_urls(table(spark, d, "pages"), url_filter.rules_frame(spark, RULES))


NORMAL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')"


@query("op7_exact_dedup", rf"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS n_points, {NORMAL} AS norm FROM documents),
g AS (SELECT norm, count(*) AS group_size, first(doc_id ORDER BY n_points DESC, doc_id) AS keep_id
      FROM n GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM n JOIN g USING (norm)""")
def op7(spark, d):
    return exact_dedup.exact_dedup(table(spark, d, "documents"))


@query("op8_toxicity")
def op8(spark, d):
    docs = table(spark, d, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, d, "labels")))


@query("op9_lm_scoring")
def op9(spark, d):
    return lm_score.lm_scores(table(spark, d, "documents"))


@query("op10_simhash_near_dedup")
def op10(spark, d):
    return simhash.simhash_classes(table(spark, d, "documents"))


@query("op6_suffix_array_dedup")
def op6(spark, d):
    cut = suffix_dedup.suffix_dedup(table(spark, d, "documents"))
    removed = F.aggregate("span_lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"),
                      F.size("span_starts").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_spelling_variants", r"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]{7,}')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
bytes AS (SELECT w, flatten(list_transform(string_split(id || ':' || w, ''), lambda c: CASE WHEN ord(c) < 128
  THEN [ord(c)::BIGINT] ELSE [192 + (ord(c) >> 6), 128 + (ord(c) & 63)] END)) AS b FROM runs),
crc AS (SELECT w, xor(list_reduce([4294967295] || b, lambda c, x: list_reduce([xor(c, x), 0, 0],
  lambda y, k: xor(y >> 4, [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
    3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108][(y & 15) + 1]))),
  4294967295) AS h FROM bytes),
noisy AS (SELECT CASE WHEN h % 31 = 0 THEN w[:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word FROM crc),
v AS (SELECT word, count(*) AS n FROM noisy WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
cut AS (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM v, LATERAL (SELECT unnest(range(1, length(word) + 1)) AS i)),
near AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT cut.word, cut.n, v.word, v.n FROM cut JOIN v ON rest = v.word
  UNION SELECT v.word, v.n, cut.word, cut.n FROM cut JOIN v ON rest = v.word),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS top, max(other_n) AS top_n FROM near GROUP BY word),
f AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= 10 * n THEN top END AS form,
  CASE WHEN top_n >= 10 * n THEN top_n END AS form_n FROM v LEFT JOIN best USING (word)),
way(word, root, further) AS (SELECT word, word, form FROM f
  UNION ALL SELECT way.word, f.word, f.form FROM way JOIN f ON way.further = f.word)
SELECT word, n, n_near, form, form_n, root FROM f JOIN (SELECT word, root FROM way WHERE further IS NULL) USING (word)""")
def op11(spark, d):
    return spelling.spelling_variants(table(spark, d, "documents"), noise=spelling.NOISE)


@query("op12_document_fingerprints")
def op12(spark, d):
    return fingerprints.edited_fingerprints(table(spark, d, "documents"))


def _nearest(books: str, pick: str) -> str:
    """Aggregate ``pick`` over (squared distance, entry) of each part in ``p`` to the entries of ``books``."""
    distance = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    return f"SELECT p.p, r, any_value(x) AS x, {pick.format(f'({distance}, e)')} FROM p JOIN {books} b ON p.p = b.p GROUP BY p.p, r"


def _moved(assigned: str, books: str) -> str:
    """Entries of ``books`` at the floor of their parts' means."""
    return f"""SELECT p, e, coalesce(m.c, b.c) AS c FROM {books} b LEFT JOIN (
  SELECT p, e, list(y ORDER BY i) AS c FROM (
    SELECT p, e, i, (sum(x[i]) - ((sum(x[i]) % count(*)) + count(*)) % count(*)) // count(*) AS y
    FROM {assigned}, LATERAL (SELECT unnest(range(1, len(x) + 1)) AS i) GROUP BY p, e, i) GROUP BY p, e) m USING (p, e)"""


@query("op13_vector_codes", f"""
WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v,
    row_number() OVER () AS r FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT r, vec_id, p, v[p * len(v) // 16 + 1:(p + 1) * len(v) // 16] AS x FROM k, range(16) t(p)),
c0 AS (SELECT p, e, x AS c FROM p JOIN (SELECT r, row_number() OVER (ORDER BY vec_id, v) - 1 AS e FROM k) USING (r)
  WHERE e < 64),
a0 AS ({_nearest("c0", "arg_min(e, {}) AS e")}),
c1 AS ({_moved("a0", "c0")}),
a1 AS ({_nearest("c1", "arg_min(e, {}) AS e")}),
c2 AS ({_moved("a1", "c1")}),
a2 AS ({_nearest("c2", "min({}) AS best")}),
o AS (SELECT r, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code, sum(best[1])::BIGINT AS error FROM a2 GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM c2) AS codebooks_sha256
FROM o JOIN k USING (r)""")
def op13(spark, d):
    return vector_codes.vector_codes(table(spark, d, "embeddings"))

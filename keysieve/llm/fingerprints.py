"""Document fingerprints: a homomorphic multiset hash of a text's paragraphs.

A text is the multiset of its lines (what ``\\n`` separates, empty lines too).
Every paragraph is hashed to a wide vector, and a text's fingerprint is the sum
of its paragraphs' vectors, each lane modulo a power of two. The sum does not
depend on the order; adding or taking away a paragraph's vector inserts or
deletes it without the rest of the text (:func:`change`).

* ``EXACT`` lanes of 64 bits hold the paragraph's BLAKE2b digest: texts of equal
  fingerprints have the same paragraphs, but for a collision of 512-bit sums.
* ``LANES`` lanes of 32 bits count the paragraph's word shingles, each added to
  or taken from one lane by its hash (a count sketch). The difference of two
  fingerprints is then a sketch of what only one of the texts has, and with it
  :func:`likeness` estimates 2ab / (aa + bb) of the texts' shingle counts, with
  an error of about 0.09 for unlike texts and less the more alike they are.

A paragraph of fewer than ``2 * SHINGLE`` words counts single words. Words are
hashed for a whole block of texts at a time, by prefix sums over its bytes.

Defined results: a null text is empty, which is one empty paragraph; a text
without words has no shingles, and is like an equal text only; rows that repeat
an id or have none are each fingerprinted; an empty table gives an empty
result; columns other than the two named are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keysieve.llm.common import map_batches, texts
from keysieve.operators.lineage import materialize

EXACT, LANES, SHINGLE = 8, 128, 3
#: Hex digits of a fingerprint.
DIGITS = 16 * EXACT + 8 * LANES
#: Bytes of text hashed at a time (a longer word is hashed whole).
WINDOW = 1 << 20
#: Rows of one task of an ordered walk.
ROWS_PER_TASK = 20_000

_MULTIPLIER = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BYTE = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    if len(_POWERS.get(base, ())) < n:
        p = np.full(max(n, 1 << 16), base, np.uint64)
        p[0] = 1
        _POWERS[base] = np.cumprod(p)
    return _POWERS[base][:n]


def _mix(h: np.ndarray) -> np.ndarray:
    """Spreads a hash's differences over all its bits."""
    for shift in (30, 27):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(31))


def _window_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(start, hash)`` of each word."""
    edge = np.diff(np.r_[True, _WHITE[data], True].astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = np.r_[np.uint64(0), np.cumsum(_BYTE[data] * _powers(_MULTIPLIER, len(data)))]
    return start, _mix((sums[end] - sums[start]) * _powers(_INVERSE, len(data) + 1)[start])


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(paragraph, hash)`` of each word of ``data``, a window at a time."""
    paragraph, hashes, at, lines = [], [], 0, 0
    while at < len(data):
        stop = min(at + WINDOW, len(data))
        while stop < len(data):
            white = np.flatnonzero(_WHITE[data[at:stop]])
            if len(white):
                stop = at + int(white[-1]) + 1
                break
            stop = min(stop + WINDOW, len(data))
        window = data[at:stop]
        start, h = _window_words(window)
        breaks = np.flatnonzero(window == 10)
        paragraph.append(lines + np.searchsorted(breaks, start))
        hashes.append(h)
        lines, at = lines + len(breaks), stop
    none = [np.empty(0, np.int64)]
    return np.concatenate(paragraph or none), np.concatenate(hashes or [np.empty(0, np.uint64)])


def _block_sums(block: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    exact = np.zeros((len(block), EXACT), np.uint64)
    size = np.empty(len(block), np.int64)
    for k, t in enumerate(block):
        lines = t.split(b"\n")
        digests = b"".join([hashlib.blake2b(p, digest_size=8 * EXACT).digest() for p in lines])
        exact[k] = np.frombuffer(digests, "<u8").reshape(-1, EXACT).sum(axis=0, dtype=np.uint64)
        size[k] = len(lines)
    paragraph, h = words(np.frombuffer(b"\n".join(block), np.uint8))
    text_of = np.repeat(np.arange(len(block)), size)
    n_words = np.bincount(paragraph, minlength=len(text_of))
    long = n_words[paragraph] >= 2 * SHINGLE
    # Shingles of the long paragraphs (their last words start none), words of the short ones.
    whole = np.flatnonzero(long[:max(0, len(h) - SHINGLE + 1)])
    whole = whole[paragraph[whole] == paragraph[whole + SHINGLE - 1]]
    shingle = np.zeros(len(whole), np.uint64)
    for k in range(SHINGLE):
        shingle = shingle * np.uint64(_MULTIPLIER) + h[whole + k]
    unit = np.concatenate([_mix(shingle), h[~long]])
    owner = text_of[np.concatenate([paragraph[whole], paragraph[~long]])]
    lane = (unit % np.uint64(LANES)).astype(np.int64)
    sign = np.where(unit >> np.uint64(63), 1.0, -1.0)
    counts = np.bincount(owner * LANES + lane, sign, len(block) * LANES).reshape(-1, LANES)
    return exact, counts.astype(np.int64)


def sums(block: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of texts as ``(exact, counts)`` lanes; counts are signed."""
    parts, rows, size = [], [], 0
    for t in block:
        rows.append(t.encode())
        size += len(rows[-1])
        if size > WINDOW:
            parts.append(_block_sums(rows))
            rows, size = [], 0
    if rows or not parts:
        parts.append(_block_sums(rows) if rows else (np.zeros((0, EXACT), np.uint64), np.zeros((0, LANES), np.int64)))
    return np.concatenate([e for e, _ in parts]), np.concatenate([c for _, c in parts])


def to_bytes(exact: np.ndarray, counts: np.ndarray) -> list[bytes]:
    lanes = np.mod(counts, 1 << 32).astype(">u4")
    return [a.tobytes() + b.tobytes() for a, b in zip(exact.astype(">u8"), lanes, strict=True)]


def to_hex(exact: np.ndarray, counts: np.ndarray) -> list[str]:
    return [b.hex() for b in to_bytes(exact, counts)]


def from_hex(fingerprints: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = b"".join(map(bytes.fromhex, fingerprints))
    rows = np.frombuffer(raw, np.uint8).reshape(-1, DIGITS // 2)
    exact = np.ascontiguousarray(rows[:, :8 * EXACT]).view(">u8").astype(np.uint64)
    return exact, np.ascontiguousarray(rows[:, 8 * EXACT:]).view(">i4").astype(np.int64)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """0 to 1 per pair of fingerprints; 1 if they are equal."""
    x, y = a[1].astype(np.float64), b[1].astype(np.float64)
    both = (x * x).sum(axis=1) + (y * y).sum(axis=1)
    near = np.clip(2 * (x * y).sum(axis=1) / np.maximum(both, 1), 0, 1)
    return np.where((a[0] == b[0]).all(axis=1), 1.0, near)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint)`` per row."""
    return map_batches(texts(docs, id_col, text_col), "doc_id long, fingerprint string",
                       lambda: lambda doc, text: (doc, to_hex(*sums(text))))


def change(prints: DataFrame, changes: DataFrame) -> DataFrame:
    """``prints(doc_id, fingerprint)`` after ``changes(doc_id, paragraph, n)``:
    ``n`` copies of a paragraph are inserted, or deleted where it is negative.
    Texts are not read. Ids must be distinct in ``prints``; changes of other
    ids are ignored. Changes are summed per batch before they are shuffled."""
    def partial():
        def step(doc: list, paragraph: list, n: list) -> tuple:
            exact, counts = sums(paragraph)
            ids, at = np.unique(np.array(doc, np.int64), return_inverse=True)
            times = np.array(n, np.int64)[:, None]
            e, c = np.zeros((len(ids), EXACT), np.uint64), np.zeros((len(ids), LANES), np.int64)
            np.add.at(e, at, exact * times.astype(np.uint64))
            np.add.at(c, at, counts * times)
            return ids.tolist(), to_hex(e, c)
        return step

    rows = changes.where("doc_id is not null and n <> 0").select(
        F.col("doc_id").cast("long"), F.coalesce("paragraph", F.lit("")), F.col("n").cast("long"))
    deltas = map_batches(rows, "doc_id long, fingerprint string", partial)
    own = prints.select(F.col("doc_id").cast("long"), "fingerprint", F.lit(True).alias("own"))

    def total(g: pa.Table) -> pa.Table:
        if not any(g["own"].to_pylist()):
            return g.select(["doc_id", "fingerprint"]).slice(0, 0)
        exact, counts = from_hex(g["fingerprint"].to_pylist())
        out = to_hex(exact.sum(axis=0, dtype=np.uint64)[None], counts.sum(axis=0)[None])
        return pa.table({"doc_id": g["doc_id"].slice(0, 1), "fingerprint": pa.array(out, pa.string())})

    return (own.unionByName(deltas.withColumn("own", F.lit(False))).groupBy("doc_id")
            .applyInArrow(total, "doc_id long, fingerprint string"))


# Each document beside the next one.

RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
#: The same with fingerprints as bytes, which are half as long.
COMPACT = RESULT.replace("fingerprint string", "fingerprint binary")
INSIDE, FIRST, LAST = 0, 1, 2


def edited_rows(doc: list, text: list[str], following: list[str]) -> list[list]:
    """Columns of ``COMPACT``: each text, its edit (the last half replaced by the
    start of ``following``) and both fingerprints. The edit's fingerprint is the
    text's, less the paragraphs from the cut on, plus those of the edit."""
    n = [len(t) for t in text]
    edits, old, new = [], [], []
    for t, f, k in zip(text, following, n, strict=True):
        keep = k - k // 2
        edits.append(t[:keep] + f[:k // 2])
        start = t.rfind("\n", 0, keep) + 1
        old.append(t[start:])
        new.append(edits[-1][start:])
    own, gone, come = sums(text), sums(old), sums(new)
    edit = own[0] - gone[0] + come[0], own[1] - gone[1] + come[1]
    ahead = sums(following[-1:])
    # Rows follow each other, so the next text's fingerprint is the next row's but for the last.
    if following[:-1] != text[1:]:
        raise ValueError("rows must follow each other")
    after = tuple(np.concatenate([x[1:], y]) for x, y in zip(own, ahead, strict=True))
    sha = [hashlib.sha256(e.encode()).hexdigest() for e in edits]
    return [doc, n, sha, to_bytes(*own), to_bytes(*edit), likeness(own, edit).tolist(), likeness(own, after).tolist()]


def _batch(schema: pa.Schema, columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``RESULT``: its fingerprint, that of its edit with the next
    document by falling id (null ids come last, equal ids by a hash of the
    text; after the last comes the first), and their likenesses.

    Rows are range-partitioned and sorted; a task walks its range and leaves
    its first and last row with their texts. The last row of a range is then
    joined to the first row of the next one."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    t = texts(docs, id_col, text_col)
    tasks = max(int(t.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-t.count() // ROWS_PER_TASK))
    # The last key deals rows that agree in id and text over ranges.
    order = [F.desc_nulls_last("doc_id"), F.asc("h"), F.asc("k")]
    rows = (t.withColumns({"h": F.xxhash64("text"), "k": F.monotonically_increasing_id()})
            .repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("doc_id", "text"))
    walk_ddl = f"{COMPACT}, edge int, part int, text string"
    walk_schema, row_schema = (to_arrow_schema(StructType.fromDDL(s)) for s in (walk_ddl, COMPACT))

    def edge(kind: int, doc, text: str) -> pa.RecordBatch:
        return _batch(walk_schema, [[doc], *([None] for _ in range(6)), [kind], [TaskContext.get().partitionId()], [text]])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, text = [], []
        for b in batches:
            if not b.num_rows:
                continue
            new = b.column(0).to_pylist(), b.column(1).to_pylist()
            if not doc:
                yield edge(FIRST, new[0][0], new[1][0])
            doc, text = doc + new[0], text + new[1]
            if len(doc) > 1:
                n = len(doc) - 1
                out = edited_rows(doc[:-1], text[:-1], text[1:])
                yield _batch(walk_schema, [*out, [INSIDE] * n, [None] * n, [None] * n])
                doc, text = doc[-1:], text[-1:]
        if doc:
            yield edge(LAST, doc[0], text[0])

    walked = materialize(rows.mapInArrow(walk, walk_ddl), "walked", "zstd")
    first = walked.where(F.col("edge") == FIRST).select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    last = walked.where(F.col("edge") == LAST).select("doc_id", "text", "part")
    parts = first.select(F.col("next_part").alias("part"))
    by_part = Window.orderBy("part")  # a row per range; after the last comes the least
    succ = parts.select("part", F.coalesce(F.lead("part").over(by_part), F.min("part").over(by_part)).alias("next_part"))
    pairs = last.join(succ, "part").join(first, "next_part").select("doc_id", "text", "following")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, text, following in zip(*(c.to_pylist() for c in b.columns), strict=True):
                yield _batch(row_schema, edited_rows([doc], [text], [following]))

    inside = walked.where(F.col("edge") == INSIDE).select(*row_schema.names)
    both = inside.unionByName(pairs.mapInArrow(close, COMPACT))
    return both.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})

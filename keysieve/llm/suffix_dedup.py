"""Removal of long byte passages that an earlier document already has.

Every byte covered by a ``LENGTH``-byte string that also starts in a document
with a smaller id is removed. Strings are compared by sorting suffixes: shards'
Burrows-Wheeler transforms are merged (``bwt_merge``) and the repeated
intervals read off. Work is brought together by content, so that no task needs
the whole corpus:

1. Documents form blocks of a bounded number of bytes, dealt by a hash of id and
   text; rows that repeat both over ``REPEATS`` times are numbered, written and
   dealt by number too, so that no block gets them all. The strings of a text
   are grouped by their smallest ``GRAM``-byte hash (minimiser): equal strings
   have equal minimisers, and neighbouring strings mostly share one, so a text
   falls into segments, each a run of strings with one minimiser.
2. Blocks report which minimisers they have (48 bits each; an accidental match
   only costs time) and about how many bytes of distinct segments. Minimisers
   of one document alone are done with; those with over ``HOT_BYTES`` are hot.
3. Segments with the others are sent, each content once per block with its
   least and greatest id, to the bucket of their minimiser. Segments with a hot
   one are sent as single strings, each to the bucket of its own hash. A bucket
   merges the transforms of its shards, finds for every string the least id that
   has it, and answers the blocks.
4. Blocks mark what the answers cover and cut it out.

Inside a passage that a third of all documents have, segments are equal and sent
once per block. At its two ends, and around a phrase shorter than ``LENGTH``,
they reach into each document's own text and differ but share the minimiser,
which is then hot; the strings, which are all that is compared, spread over all
buckets. Blocks and buckets both grow in number with the text, their size is
bounded; messages between them are one row per pair of a block and a bucket.

Defined results: a null text is empty; a null id is larger than any other, and
such rows never cover each other; rows that repeat an id don't cover each other
either; matches never cross documents; texts shorter than ``LENGTH`` stay as
they are; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keysieve.llm.bwt_merge import DEPTH, LENGTH, merged
from keysieve.llm.common import texts
from keysieve.operators.lineage import materialize

GRAM = 24
#: Bytes of a block of documents, of a piece hashed at a time, of a shard.
BLOCK_BYTES, PIECE_BYTES, SHARD_BYTES = 8 << 20, 1 << 19, 1 << 18
#: Buckets of segments per block: a merge takes some twenty numbers per byte.
BUCKETS_PER_BLOCK = 2
#: Bytes of distinct segments (of a block each) from which a minimiser is hot; bytes of a usual
#: segment at most, in which they are reported.
HOT_BYTES, UNIT = 1 << 19, 2 * LENGTH - GRAM
#: Rows of equal id and text that may share a block.
REPEATS = 16
#: Blocks whose minimisers are compared by one task.
ASKED_BLOCKS = 4
#: Bytes of a segment's name among those of its block.
KEY = 12
LAST_ID = np.iinfo(np.int64).max
U64 = np.uint64


def _smallest(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    n, span = len(x) - width + 1, 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:n], x[width - span:width - span + n])


def segments(docs: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(document, start, strings, minimiser, print)`` arrays, some documents
    at a time: runs of ``strings`` strings from byte ``start`` on, minimisers 48
    bits, prints (sums of the segment's hashes) to count distinct segments by."""
    at = 0
    while at < len(docs):
        stop, size = at, 0
        while stop < len(docs) and (stop == at or size < PIECE_BYTES):
            size += len(docs[stop])
            stop += 1
        text = np.frombuffer(b"".join(docs[at:stop]) + bytes(8), np.uint8)
        if size >= LENGTH:
            lens = np.array([len(d) for d in docs[at:stop]])
            words = np.ndarray((size,), "<u8", text, 0, (1,))  # the eight bytes from each byte on
            h = np.zeros(size - GRAM + 1, U64)
            for j in range(0, GRAM, 8):
                h = (h ^ words[j:j + len(h)]) * U64(0x9E3779B97F4A7C15)
                h ^= h >> U64(29)
            low = _smallest(h, LENGTH - GRAM + 1) >> U64(16)
            owner = np.repeat(np.arange(len(lens)), lens)
            inside = owner[:len(low)] == owner[LENGTH - 1:]
            new = inside.copy()
            new[1:] &= ~inside[:-1] | (low[1:] != low[:-1])
            start = np.flatnonzero(new)
            if len(start):
                n = np.bincount(np.cumsum(new)[inside] - 1)
                doc, total = owner[start], np.r_[U64(0), np.cumsum(h)]
                yield (doc + at, start - (np.cumsum(lens) - lens)[doc], n, low[start],
                       total[start + n + LENGTH - GRAM] - total[start])
        at = stop


def _pack48(h: np.ndarray) -> bytes:
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack48(b: bytes) -> np.ndarray:
    raw = np.frombuffer(b, np.uint8).reshape(-1, 6)
    return np.pad(raw, ((0, 0), (0, 2))).view("<u8").ravel()


def _packed(*parts: bytes) -> bytes:
    """Parts in one compressed message."""
    return zstandard.compress(b"".join([np.array([len(p) for p in parts], np.int64).tobytes(), *parts]), 3)


def _unpacked(message: bytes, n: int) -> list[bytes]:
    raw = zstandard.decompress(message)
    cuts = 8 * n + np.r_[0, np.cumsum(np.frombuffer(raw, np.int64, n))]
    return [raw[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False)]


def _block(t: pa.Table) -> tuple[list[bytes], np.ndarray]:
    """Texts and ids of a block's documents."""
    ids = t["doc_id"].fill_null(LAST_ID).to_numpy()
    return t["text"].cast(pa.binary()).to_pylist(), ids


def _by(part: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(n + 1))
    for p in range(n):
        if cuts[p] < cuts[p + 1]:
            yield p, order[cuts[p]:cuts[p + 1]]


def _minimisers(docs: list[bytes], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct minimisers of a block, which of them two ids have, and the
    bytes of their distinct segments as a power of two in quarters of UNIT."""
    found = [(m, ids[d], n + LENGTH - 1, mark) for d, _, n, m, mark in segments(docs)]
    if not found:
        return np.empty(0, U64), np.empty(0, bool), np.empty(0, np.uint8)
    m, d, size, mark = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((mark, m))
    m, d, size, mark = m[order], d[order], size[order], mark[order]
    new = np.r_[True, m[1:] != m[:-1]]
    first = np.flatnonzero(new)
    new[1:] |= mark[1:] != mark[:-1]
    size = np.add.reduceat(np.where(new, size, 0), first)
    return (m[first], np.minimum.reduceat(d, first) < np.maximum.reduceat(d, first),
            np.ceil(4 * np.log2(np.maximum(size / UNIT, 1))).astype(np.uint8))


def _asker(parts: int):
    def ask(t: pa.Table) -> pa.Table:
        m, shared, size = _minimisers(*_block(t))
        block = t["block"][0].as_py()
        rows = [(p, block, _pack48(m[k]), np.packbits(shared[k]).tobytes(), size[k].tobytes())
                for p, k in _by((m % U64(parts)).astype(np.int64), parts)]
        return _rows(rows, ASKED)
    return ask


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


ASKED = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("grams", pa.binary()), ("shared", pa.binary()),
                   ("size", pa.binary())])
TOLD = pa.schema([("block", pa.int32()), ("grams", pa.binary()), ("hot", pa.binary())])
SENT = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("payload", pa.binary())])
ANSWER = pa.schema([("block", pa.int32()), ("payload", pa.binary())])
OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("kept", pa.binary()),
                 ("span_starts", pa.list_(pa.int64())), ("span_lengths", pa.list_(pa.int64()))])


def _teller(hot_bytes: int):
    def tell(t: pa.Table) -> pa.Table:
        """To each block, those of its minimisers that two ids have, and which are hot."""
        grams = [_unpack48(b) for b in t["grams"].to_pylist()]
        shared = [np.unpackbits(np.frombuffer(b, np.uint8), count=len(g)).astype(bool)
                  for b, g in zip(t["shared"].to_pylist(), grams, strict=True)]
        size = np.concatenate([np.frombuffer(b, np.uint8) for b in t["size"].to_pylist()])
        s = np.concatenate(grams)
        order = np.argsort(s, kind="stable")
        s = s[order]
        first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
        total = np.add.reduceat(UNIT * 2.0 ** (size[order] / 4), first)
        # A block has a minimiser once, so one that comes twice has two ids as well.
        twice = np.diff(np.r_[first, len(s)]) > 1
        known = s[first]
        twice |= np.isin(known, np.concatenate([g[k] for g, k in zip(grams, shared, strict=True)]))
        known, hot = known[twice], total[twice] > hot_bytes
        rows = []
        for block, g in zip(t["block"].to_pylist(), grams, strict=True) if len(known) else ():
            at = np.minimum(np.searchsorted(known, g), len(known) - 1)
            hit = known[at] == g
            if hit.any():
                rows.append((block, _pack48(g[hit]), np.packbits(hot[at[hit]]).tobytes()))
        return _rows(rows, TOLD)
    return tell


def _sender(buckets: int):
    def send(t: pa.Table, told: pa.Table) -> pa.Table:
        """A block's distinct segments with minimisers of several ids."""
        if not t.num_rows or not told.num_rows:
            return _rows([], SENT)
        docs, ids = _block(t)
        known = [_unpack48(b) for b in told["grams"].to_pylist()]
        hot = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=len(g)).astype(bool)
                              for b, g in zip(told["hot"].to_pylist(), known, strict=True)])
        known = np.concatenate(known)
        order = np.argsort(known)
        known, hot = known[order], hot[order]
        index: dict[bytes, int] = {}
        grams, strings, who, apart = [], [], [], []
        for d, start, n, m, _ in segments(docs):
            at = np.minimum(np.searchsorted(known, m), len(known) - 1)
            hit = known[at] == m
            d, start, n, m, single = d[hit], start[hit], n[hit], m[hit], hot[at[hit]]
            if single.any():  # each string of a hot segment by itself
                times = np.where(single, n, 1)
                first = np.repeat(np.cumsum(times) - times, times)
                start = np.repeat(start, times) + np.arange(len(first)) - first
                n = np.repeat(np.where(single, 1, n), times)
                d, m, single = (np.repeat(x, times) for x in (d, m, single))
            put = index.setdefault
            slot = np.array([put(docs[i][a:b], len(index)) for i, a, b in zip(
                d.tolist(), start.tolist(), (start + n + LENGTH - 1).tolist(), strict=True)], np.int64)
            grams.append(m)
            strings.append(n)
            apart.append(single)
            who.append((slot, ids[d]))
        slot, owner = (np.concatenate(x) for x in zip(*who, strict=True))
        least, greatest = np.full(len(index), LAST_ID), np.full(len(index), np.iinfo(np.int64).min)
        np.minimum.at(least, slot, owner)
        np.maximum.at(greatest, slot, owner)
        m, n = np.empty(len(index), U64), np.empty(len(index), np.int64)
        m[slot], n[slot] = np.concatenate(grams), np.concatenate(strings)
        contents, block, several = list(index), t["block"][0].as_py(), least < greatest
        route = m.copy()
        for i in np.unique(slot[np.concatenate(apart)]).tolist():
            route[i] = xxhash.xxh3_64_intdigest(contents[i])
        return _rows([(b, block, _packed(
            _pack48(m[k]), n[k].astype(np.int32).tobytes(), b"".join([contents[i] for i in k.tolist()]),
            least[k].tobytes(), np.packbits(several[k]).tobytes()))
            for b, k in _by(((route >> U64(8)) % U64(buckets)).astype(np.int64), buckets)], SENT)
    return send


def least_ids(contents: list[bytes], strings: np.ndarray, least: np.ndarray, shard_bytes: int) -> np.ndarray:
    """For every string of distinct segments (one after the other), the least
    of the ids whose segments have the string."""
    size = strings + LENGTH - 1
    bounds = np.r_[0, np.cumsum(size)]
    shards = np.r_[0, np.searchsorted(bounds[:-1], np.arange(shard_bytes, bounds[-1], shard_bytes)), len(contents)]
    text = np.frombuffer(b"".join(contents), np.uint8)
    position, common = merged(text, bounds, np.unique(shards))
    segment = np.repeat(np.arange(len(contents)), size)
    whole = np.arange(len(text)) - bounds[segment] < strings[segment]  # a string starts here
    ids = np.where(whole, least[segment], LAST_ID)
    first = np.flatnonzero(common < DEPTH)  # repeated intervals lie between these
    interval = np.cumsum(common < DEPTH) - 1
    out = np.empty(len(text), np.int64)
    out[position] = np.minimum.reduceat(ids[position], first)[interval]
    return out[whole]


def _key(content: bytes) -> bytes:
    """A segment's name in an answer to a block."""
    return xxhash.xxh3_128_digest(content)[:KEY]


def _solve(t: pa.Table) -> pa.Table:
    """Answers of a bucket: per block, its segments of which another id than
    the block's only one has a string, as runs of strings with their least id."""
    grams, strings, texts_, least, shared = zip(*(_unpacked(b, 5) for b in t["payload"].to_pylist()), strict=True)
    grams, strings = [_unpack48(b) for b in grams], [np.frombuffer(b, np.int32).astype(np.int64) for b in strings]
    least = [np.frombuffer(b, np.int64) for b in least]
    shared = [np.unpackbits(np.frombuffer(b, np.uint8), count=len(n)).astype(bool)
              for b, n in zip(shared, strings, strict=True)]
    index: dict[bytes, int] = {}
    slots, put = [], index.setdefault
    for text, n in zip(texts_, strings, strict=True):
        ends = np.cumsum(n + LENGTH - 1)
        slots.append(np.array([put(text[a:b], len(index)) for a, b in zip(
            (ends - n - LENGTH + 1).tolist(), ends.tolist(), strict=True)], np.int64))
    del texts_
    contents, slot = list(index), np.concatenate(slots)
    n_of, gram_of = np.empty(len(contents), np.int64), np.empty(len(contents), U64)
    n_of[slot], gram_of[slot] = np.concatenate(strings), np.concatenate(grams)
    least_of = np.full(len(contents), LAST_ID)
    np.minimum.at(least_of, slot, np.concatenate(least))

    # Strings of a segment that is alone with its minimiser occur in no other segment, nor do those
    # of segments that are one string each (contents are distinct).
    order = np.argsort(gram_of, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(gram_of[order]) != 0])
    members = np.diff(np.r_[first, len(order)])
    several = order[np.repeat((members > 1) & (np.maximum.reduceat(n_of[order], first) > 1), members)]
    ids = np.repeat(least_of, n_of)
    start = np.cumsum(n_of) - n_of
    if len(several):
        got = least_ids([contents[i] for i in several.tolist()], n_of[several], least_of[several], SHARD_BYTES)
        spread = np.repeat(start[several] - (np.cumsum(n_of[several]) - n_of[several]), n_of[several])
        ids[spread + np.arange(len(got))] = got

    # Runs of equal ids within a segment.
    new = np.r_[True, ids[1:] != ids[:-1]]
    new[start] = True
    run = np.flatnonzero(new)
    run_length, run_id = np.diff(np.r_[run, len(ids)]), ids[run]
    run_from = np.searchsorted(run, start)
    n_runs = np.diff(np.r_[run_from, len(run)])
    lowest = np.minimum.reduceat(ids, start)

    rows = []
    for block, s, own, more in zip(t["block"].to_pylist(), slots, least, shared, strict=True):
        s = s[(lowest[s] < own) | more]
        if len(s):
            k = n_runs[s]
            at = np.repeat(run_from[s] - (np.cumsum(k) - k), k) + np.arange(k.sum())
            keys = b"".join([_key(contents[i]) for i in s.tolist()])
            rows.append((block, _packed(_pack48(gram_of[s]), keys, k.astype(np.int32).tobytes(),
                                        run_length[at].astype(np.int32).tobytes(), run_id[at].tobytes())))
    return _rows(rows, ANSWER)


def _cut(t: pa.Table, answers: pa.Table) -> pa.Table:
    """A block's documents without what the answers cover."""
    if not t.num_rows:
        return _rows([], OUT)
    docs, ids = _block(t)
    spans: list[list[tuple[int, int]]] = [[] for _ in docs]
    if answers.num_rows:
        grams, keys, k, lengths, owners = (b"".join(x) for x in zip(
            *(_unpacked(b, 5) for b in answers["payload"].to_pylist()), strict=True))
        grams = _unpack48(grams)
        known = np.unique(grams)
        k = np.frombuffer(k, np.int32).astype(np.int64)
        single = np.frombuffer(lengths, np.int32)[np.cumsum(k) - k] == 1
        single = np.isin(known, grams[single & (k == 1)])  # may have been sent as single strings
        lengths, owners = np.frombuffer(lengths, np.int32).tolist(), np.frombuffer(owners, np.int64).tolist()
        runs = {keys[KEY * i:KEY * (i + 1)]: (a, b) for i, (a, b) in enumerate(
            zip((np.cumsum(k) - k).tolist(), np.cumsum(k).tolist(), strict=True))}
        for d, start, n, m, _ in segments(docs):
            at = np.minimum(np.searchsorted(known, m), len(known) - 1)
            hit = known[at] == m
            for i, a, b, apart in zip(d[hit].tolist(), start[hit].tolist(), (start + n + LENGTH - 1)[hit].tolist(),
                                      single[at[hit]].tolist(), strict=True):
                got, own = runs.get(_key(docs[i][a:b])), ids[i]
                if got is not None:
                    for r in range(*got):
                        if owners[r] < own:
                            spans[i].append((a, a + lengths[r] + LENGTH - 1))
                        a += lengths[r]
                elif apart:
                    for c in range(a, b - LENGTH + 1):
                        got = runs.get(_key(docs[i][c:c + LENGTH]))
                        if got is not None and owners[got[0]] < own:
                            spans[i].append((c, c + LENGTH))
    rows = []
    for i, doc in enumerate(docs):
        out: list[list[int]] = []
        for a, b in spans[i]:  # by start
            if out and a <= out[-1][1]:
                out[-1][1] = max(out[-1][1], b)
            else:
                out.append([a, b])
        edges = [0, *(x for s in out for x in s), len(doc)]
        kept = b"".join([doc[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)])
        rows.append((None if ids[i] == LAST_ID else int(ids[i]), len(doc), kept,
                     [a for a, _ in out], [b - a for a, b in out]))
    return _rows(rows, OUT)


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary",
             pa.list_(pa.int64()): "array<long>"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def place(t: DataFrame, blocks: int, repeats: int = REPEATS) -> DataFrame:
    """Rows ``(doc_id, text)`` with their ``block``, the same whenever it is computed."""
    keyed = t.withColumn("key", F.xxhash64("doc_id", "text"))
    often = materialize(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > repeats).select("key"),
                        "often")
    # A row's number is fixed once it is written.
    many = materialize(keyed.join(often, "key", "left_semi").select(
        "doc_id", "text", F.xxhash64("key", F.monotonically_increasing_id()).alias("key")), "repeated")
    return (keyed.join(often, "key", "left_anti").select("doc_id", "text", "key").unionByName(many)
            .select("doc_id", "text", F.pmod(F.col("key"), F.lit(blocks)).cast("int").alias("block")))


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 block_bytes: int = BLOCK_BYTES, hot_bytes: int = HOT_BYTES,
                 repeats: int = REPEATS) -> DataFrame:
    """Per row: ``doc_id, n_bytes, kept`` (the remaining bytes), ``span_starts,
    span_lengths`` (the maximal removed runs, in bytes)."""
    t = texts(docs, id_col, text_col)
    size = t.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    parts = max(1, math.ceil(blocks / ASKED_BLOCKS))
    placed = place(t, blocks, repeats)
    told = (placed.groupBy("block").applyInArrow(_asker(parts), _ddl(ASKED))
            .groupBy("part").applyInArrow(_teller(hot_bytes), _ddl(TOLD)))
    answers = (placed.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
                   _sender(blocks * BUCKETS_PER_BLOCK), _ddl(SENT))
               .groupBy("bucket").applyInArrow(_solve, _ddl(ANSWER)))
    return placed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_cut, _ddl(OUT))

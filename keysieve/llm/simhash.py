"""SimHash near-duplicates found by Golay-code fuzzy hashing.

Fingerprints of 64 bits link at ``max_bits`` (at most 3) or fewer differing
bits; classes are the connected components of the links. Equal fingerprints are
one node, so copies cost nothing beyond their own row.

Search: a fingerprint is three segments of 22, 21 and 21 bits, each padded to
the 23 bits of the perfect binary Golay code. Three errors spread over three
segments leave at least two segments with at most one error each (pigeonhole).
Decoding maps a segment to the one codeword within three bits; a segment just
three bits off also gets the five codewords at four bits. If two segments
differ in at most one bit, the codeword of one is among the keys of the other.
So for every pair of segments (i, j) a fingerprint emits its own codeword of j
with all keys of i, and its own codeword of i with all keys of j; two linked
fingerprints meet in one of these 24-bit keys. Within a key every fingerprint
is compared with the others, so no link is lost, but only a spanning forest of
the key's links is emitted: a large group of near-copies gives as many rows as
it has members, not pairs. A key with very many members is split over tasks.

Defined results: null is empty; a text without words has fingerprint zero and
links like any other; rows that repeat an id are each listed; a null id never
names a component unless all its members lack one; an empty table gives an
empty result; columns other than the two named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keysieve.llm.common import map_batches, texts
from keysieve.llm.components import components
from keysieve.operators.lineage import materialize

SHINGLE, MAX_BITS, SEED = 3, 3, 42
#: Fixed value: generator polynomial of the (23, 12) Golay code.
GENERATOR = 0b110001110101
#: (shift, bits) of the segments; segments are padded at the low end.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Shingle hashes counted at a time, and fingerprints compared at a time.
BLOCK = 1 << 16
#: Runs up to this size are compared pair by pair; longer ones grow clusters.
SMALL_RUN = 32
#: Members of a key that are compared in one task; a larger key is dealt out.
MAX_RUN = 200_000


def fingerprint(text: str, k: int = SHINGLE, seed: int = SEED) -> int:
    """Bit i is set if over half of the shingles' XXH64 hashes have it set."""
    w = text.encode().lower().split()  # bytes: ASCII case and white space only
    if not w:
        return 0
    shingles = map(b" ".join, zip(*(w[i:] for i in range(k)))) if len(w) > k else iter([b" ".join(w)])
    hash64, counts, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), max(1, len(w) - k + 1)
    hashes = np.fromiter((hash64(s, seed) for s in shingles), np.uint64, n)
    for i in range(0, n, BLOCK):
        bits = np.unpackbits(hashes[i:i + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, k: int = SHINGLE, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)`` per row; fp is the fingerprint as a signed long."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return map_batches(texts(docs, id_col, text_col), "doc_id long, fp long",
                       lambda: lambda doc, text: (doc, [signed(fingerprint(t, k)) for t in text]))


@cache
def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(remainder of the high 12 bits, error of a syndrome, key offsets of a
    syndrome)``. A word's codeword is word XOR error; its index is the high 12
    bits. Offsets are XORed on an index; unused ones are 0 (the own codeword)."""
    rem = np.arange(1 << 12, dtype=np.int64) << 11
    for bit in range(22, 10, -1):
        rem = np.where(rem >> bit & 1, rem ^ (GENERATOR << (bit - 11)), rem)
    syndrome = lambda v: rem[v >> 11] ^ (v & 0x7FF)
    one = 1 << np.arange(23, dtype=np.int64)
    errors = [np.zeros(1, np.int64), one]
    i, j = np.triu_indices(23, 1)
    errors.append(one[i] ^ one[j])
    errors.append(np.unique((errors[2][:, None] ^ one[None, :]).ravel()))
    errors[3] = errors[3][np.bitwise_count(errors[3]) == 3]
    error = np.zeros(1 << 11, np.int64)
    for e in errors:
        error[syndrome(e)] = e
    offsets = np.zeros((1 << 11, 6), np.int64)
    for s, e in enumerate(error):
        if np.bitwise_count(e) == 3:
            near = e ^ one
            index = np.unique((near ^ error[syndrome(near)]) >> 11)
            offsets[s, 1:] = index[index != 0]
    return rem, error, offsets


def segment_keys(fp: np.ndarray, segment: int) -> tuple[np.ndarray, np.ndarray]:
    """Own codeword index (n) and all key indices (n, 6) of a segment."""
    rem, error, offsets = golay_tables()
    shift, bits = SEGMENTS[segment]
    word = ((fp >> np.uint64(shift)) & np.uint64((1 << bits) - 1)).astype(np.int64) << (23 - bits)
    s = rem[word >> 11] ^ (word & 0x7FF)
    own = (word ^ error[s]) >> 11
    return own, own[:, None] ^ offsets[s]


def fuzzy_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(position in fp, key)``: keys in which linked fingerprints meet."""
    parts = [segment_keys(fp, s) for s in range(3)]
    rows, keys = [], []
    for p, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        (own_i, all_i), (own_j, all_j) = parts[i], parts[j]
        for key in ((all_i << 12) | own_j[:, None], (own_i[:, None] << 12) | all_j):
            new = np.ones(key.shape, bool)  # offset 0 stands for the own codeword once
            new[:, 1:] = key[:, 1:] != key[:, :1]
            at, _ = np.nonzero(new)
            rows.append(at)
            keys.append(key[new] | (p << 24))
    return np.concatenate(rows), np.concatenate(keys)


def _emit_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        at, key = fuzzy_keys(fp.view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[at])], names=["key", "fp"])


def forest(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the clusters of ``fp`` (distinct): clusters grow from a
    seed, and what has been reached is not compared again."""
    a, b, rest = [], [], fp
    while len(rest):
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            f = frontier.pop()
            near = np.bitwise_count(rest ^ f) <= max_bits
            if near.any():
                got = rest[near]
                a.append(np.full(len(got), f))
                b.append(got)
                frontier.extend(got)
                rest = rest[~near]
    none = np.empty(0, np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def links_of_runs(key: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among fingerprints of equal key; rows are sorted by key, then fp."""
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (fp[1:] != fp[:-1])
    key, fp = key[new], fp[new]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[first, len(key)])
    a, b = [], []
    small = np.repeat(size <= SMALL_RUN, size)
    for d in range(1, min(SMALL_RUN, size.max(initial=1))):
        near = (key[d:] == key[:-d]) & small[d:]
        near[near] = np.bitwise_count(fp[d:][near] ^ fp[:-d][near]) <= max_bits
        a.append(fp[:-d][near])
        b.append(fp[d:][near])
    for k in np.flatnonzero(size > SMALL_RUN):
        x, y = forest(fp[first[k]:first[k] + size[k]], max_bits)
        a.append(x)
        b.append(y)
    none = [np.empty(0, np.uint64)]
    return np.concatenate(a or none), np.concatenate(b or none)


def runs(keyed: DataFrame, max_run: int) -> DataFrame:
    """``(run, fp)``: fingerprints to be compared with each other, by key. The
    members of a key with more than ``max_run`` are dealt to parts, and every
    pair of parts is a run, so no task holds more than two parts of a key."""
    # Key (26 bits) and pair of parts in one number.
    run = lambda pair: F.shiftleft("key", 36) + pair
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_run)
    hot = materialize(sizes.select("key", F.ceil(F.col("n") / max_run).alias("parts")), "hot-keys")
    if hot.isEmpty():
        return keyed.select(run(F.lit(0)).alias("run"), "fp")
    own = F.pmod(F.xxhash64("fp"), F.col("parts"))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1),
                        lambda c: F.least(own, c) * F.col("parts") + F.greatest(own, c))
    alone = F.array(F.lit(0).cast("long"))
    return keyed.join(hot, "key", "left").select("key", "fp", F.explode(
        F.when(F.col("parts").isNull(), alone).otherwise(pairs)).alias("pair")).select(
        run(F.col("pair")).alias("run"), "fp")


def links(fps: DataFrame, max_bits: int = MAX_BITS, max_run: int = MAX_RUN) -> DataFrame:
    """``(a, b)``: links that connect whatever lies within ``max_bits``."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the code's keys are complete for up to 3 differing bits")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, fp = np.empty(0, np.int64), np.empty(0, np.int64)
        for b in _then_none(batches):
            if b is not None:
                run = np.r_[run, b.column(0).to_numpy()]
                fp = np.r_[fp, b.column(1).to_numpy()]
                if not len(run) or run[0] == run[-1]:
                    continue
                end = int(np.searchsorted(run, run[-1]))  # the last run may go on in the next batch
            else:
                end = len(run)
            x, y = links_of_runs(run[:end], fp[:end].view(np.uint64), max_bits)
            run, fp = run[end:], fp[end:]
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))],
                                             names=["a", "b"])

    keyed = fps.select("fp").distinct().mapInArrow(_emit_keys, "key long, fp long")
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = runs(keyed, max_run).repartition(n, "run").sortWithinPartitions("run", "fp")
    return met.mapInArrow(compare, "a long, b long").distinct()


def _then_none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def simhash_classes(docs: DataFrame, k: int = SHINGLE, max_bits: int = MAX_BITS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, fingerprint`` (16 hex digits), ``component_id``."""
    rows = materialize(fingerprints(docs, k, id_col, text_col), "fingerprints")
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    comp = components(links(nodes, max_bits)).select(F.col("node").alias("fp"), "root")
    rooted = materialize(nodes.join(comp, "fp", "left")
                         .select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "rooted")
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = materialize(rooted.join(ids, "root").select("fp", "component_id"), "classes")
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

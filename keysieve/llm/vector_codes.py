"""Compression of vectors to product codes, with nearest entries found by a GNAT.

A vector is scaled to integers and cut into equal parts. Each part position has
a codebook of a few dozen entries; a vector's code is the index of the nearest
entry per part. Codebooks start as the parts of the first vectors and are moved
to their parts' means for a fixed number of rounds, all in integers, so that
the result does not depend on how the rows are spread over tasks.

The nearest entry is searched with a geometric near-neighbour access tree
(GNAT) over a codebook. A node has a few split points that lie far apart; every
other entry belongs to the nearest split, and for each split and each child the
node stores the least and the greatest distance from that split to the child's
entries. If a query's distance to a split, less its best distance so far, is
over the greatest (or their sum is under the least), the child cannot even tie
and is skipped whole. Ranges and query distances are rounded outwards and
compared strictly, so rounding never skips a nearest entry; distances that
decide are squared integers, and a tie goes to the lower index. A task searches
for all vectors of a batch at once.

A round sums parts per entry inside each task, then over tasks; only codebooks
(entries times dimension integers) reach the driver.

Defined results: rows whose vector is null or has null or non-finite components
are left out, and so are rows whose vector is not as long as most (of lengths
that are a positive multiple of the parts; ties: the shorter); a component that
is 2^27 or more after scaling stops the job, as squared errors would not fit a
long; fewer vectors than entries give shorter codebooks; rows that repeat an id
are each coded, and start codebooks in the order of their vectors; a null id
comes after all others; null labels are one label; an empty table gives an
empty result; columns other than the three named are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keysieve.operators.lineage import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Scaled components are below this.
LIMIT = 1 << 27
#: Split points of a node, and entries up to which a node is a plain list.
FAN, LEAF = 6, 4
#: Relative margin of a rounded square root, well above its error.
MARGIN = 2.0 ** -50

Codebooks = list[np.ndarray]


def _roots(squared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds below and above of the square roots."""
    r = np.sqrt(squared.astype(np.float64))
    return r * (1 - MARGIN), r * (1 + MARGIN)


class Gnat:
    """Nearest entry of integer points, by squared Euclidean distance, then index."""

    def __init__(self, entries: np.ndarray, fan: int = FAN, leaf: int = LEAF):
        self.entries, self.fan, self.leaf = entries, fan, leaf
        self.computed = 0  # distances between queries and entries, for tests
        self.root = self._build(np.arange(len(entries)))

    def _squared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        d = self.entries[a][:, None, :] - self.entries[b][None, :, :]
        return (d * d).sum(axis=2)

    def _build(self, members: np.ndarray):
        """A list of entries, or (splits, children, least, greatest): the
        ranges have a row per split and a column per child."""
        if len(members) <= self.leaf:
            return members
        splits = [members[0]]
        apart = self._squared(members, members[:1])[:, 0]
        while len(splits) < self.fan and apart.max() > 0:
            splits.append(members[apart.argmax()])
            apart = np.minimum(apart, self._squared(members, np.array(splits[-1:]))[:, 0])
        if len(splits) == 1:
            return members  # all alike
        splits = np.array(splits)
        rest = np.setdiff1d(members, splits)
        squared = self._squared(splits, rest)
        owner = squared.argmin(axis=0)
        children, least, greatest = [], [], []
        for k in np.unique(owner):
            mine = owner == k
            children.append(self._build(rest[mine]))
            least.append(_roots(squared[:, mine].min(axis=1))[0])
            greatest.append(_roots(squared[:, mine].max(axis=1))[1])
        return splits, children, np.array(least).T, np.array(greatest).T

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(index, squared distance)`` per point."""
        index = np.full(len(points), len(self.entries), np.int64)
        best = np.full(len(points), np.iinfo(np.int64).max, np.int64)
        if len(points):
            self._search(self.root, points, np.arange(len(points)), index, best)
        return index, best

    def _offer(self, entry: int, points, rows, index, best) -> np.ndarray:
        d = points[rows] - self.entries[entry]
        squared = (d * d).sum(axis=1)
        self.computed += len(rows)
        better = (squared < best[rows]) | ((squared == best[rows]) & (entry < index[rows]))
        best[rows[better]], index[rows[better]] = squared[better], entry
        return squared

    def _search(self, node, points, rows, index, best) -> None:
        if isinstance(node, np.ndarray):
            for entry in node:
                self._offer(entry, points, rows, index, best)
            return
        splits, children, least, greatest = node
        below, above = _roots(np.array([self._offer(s, points, rows, index, best) for s in splits]))
        for k, child in enumerate(children):
            radius = _roots(best[rows])[1]
            apart = (below - radius > greatest[:, k, None]) | (above + radius < least[:, k, None])
            near = ~apart.any(axis=0)
            if near.any():
                self._search(child, points, rows[near], index, best)


def scaled(vectors: DataFrame, parts: int = PARTS, scale: int = SCALE, id_col: str = "vec_id",
           vec_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, int]:
    """``(vec_id, label, v)`` of the vectors kept, as a table, and their length
    (0: none is kept)."""
    df = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                        F.col(vec_col).alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column(2)
            n = pc.fill_null(pc.list_value_length(v), 0).to_numpy().astype(np.int64)
            x = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null: not a number
            row = np.repeat(np.arange(len(n)), n)
            good = ~np.isin(np.arange(len(n)), row[~np.isfinite(x)]) & (n > 0) & (n % parts == 0)
            x = np.floor(x[good[row]] * scale)
            if len(x) and np.abs(x).max() >= LIMIT:
                raise ValueError(f"a component is {LIMIT} or more after scaling")
            ends = np.r_[0, np.cumsum(n[good])].astype(np.int32)
            out = pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32)))
            mask = pa.array(good)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(mask), b.column(1).filter(mask), out],
                                             names=["vec_id", "label", "v"])

    label = df.schema["label"].dataType.simpleString()
    kept = materialize(df.mapInArrow(run, f"vec_id long, label {label}, v array<int>"), "vectors")
    most = kept.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").head()
    return (kept.where(F.size("v") == most["n"]), most["n"]) if most else (kept, 0)


def _batches(kept: DataFrame, dim: int, parts: int, schema: str,
             step: Callable[[pa.RecordBatch, list[np.ndarray]], pa.RecordBatch | None],
             end: Callable[[], pa.RecordBatch] | None = None) -> DataFrame:
    """``step(batch, its parts)`` over the batches of ``kept``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(b.num_columns - 1).flatten().to_numpy().astype(np.int64).reshape(-1, parts, dim // parts)
            out = step(b, [x[:, p] for p in range(parts)])
            if out is not None:
                yield out
        if end is not None:
            yield end()

    return kept.mapInArrow(run, schema)


def first_codebooks(kept: DataFrame, dim: int, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks:
    """Parts of the ``entries`` vectors of least id."""
    rows = kept.select("vec_id", "v").orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()
    x = np.array([r["v"] for r in rows], np.int64).reshape(len(rows), parts, dim // parts)
    return [x[:, p].copy() for p in range(parts)]


def moved_codebooks(kept: DataFrame, dim: int, books: Codebooks) -> Codebooks:
    """Each entry at the floor of the mean of the parts nearest to it."""
    parts, width, entries = len(books), dim // len(books), len(books[0])
    trees: list[Gnat] = []
    total = np.zeros((parts, entries, width + 1), np.int64)  # the last number counts parts

    def add(b: pa.RecordBatch, xs: list[np.ndarray]) -> None:
        if not trees:
            trees.extend(map(Gnat, books))
        for p, x in enumerate(xs):
            k = trees[p].nearest(x)[0]
            # Sums of one batch are far below 2^53, where doubles are whole numbers.
            for j, column in enumerate((*x.T, np.ones(len(x)))):
                total[p, :, j] += np.bincount(k, column, entries).astype(np.int64)

    def sums() -> pa.RecordBatch:
        at = np.indices(total.shape).reshape(3, -1).astype(np.int32)
        return pa.RecordBatch.from_arrays([*map(pa.array, at), pa.array(total.ravel())], names=["p", "e", "j", "s"])

    rows = _batches(kept, dim, parts, "p int, e int, j int, s long", add, sums)
    out = np.zeros_like(total)
    for r in rows.groupBy("p", "e", "j").agg(F.sum("s").alias("s")).collect():  # entries x (dim + parts) rows
        out[r["p"], r["e"], r["j"]] = r["s"]
    count = out[:, :, width:]
    return list(np.where(count > 0, out[:, :, :width] // np.maximum(count, 1), np.array(books)))


def coded(kept: DataFrame, dim: int, books: Codebooks) -> DataFrame:
    """``vec_id, label, code, error``."""
    trees: list[Gnat] = []

    def step(b: pa.RecordBatch, xs: list[np.ndarray]) -> pa.RecordBatch:
        if not trees:
            trees.extend(map(Gnat, books))
        found = [t.nearest(x) for t, x in zip(trees, xs, strict=True)]
        code = np.stack([k for k, _ in found], axis=1).astype(np.uint8)
        error = sum(d for _, d in found)
        return pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array([c.tobytes().hex() for c in code], pa.string()), pa.array(error)],
            names=["vec_id", "label", "code", "error"])

    label = kept.schema["label"].dataType.simpleString()
    return _batches(kept, dim, len(books), f"vec_id long, label {label}, code string, error long", step)


def codebooks_text(books: Codebooks) -> str:
    """All entries' components by part, entry and position, comma-joined."""
    return ",".join(str(x) for book in books for x in book.ravel())


def decode(code: str, books: Codebooks) -> np.ndarray:
    """The scaled vector that a code stands for."""
    return np.concatenate([b[k] for b, k in zip(books, bytes.fromhex(code), strict=True)])


def train(kept: DataFrame, dim: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    if entries > 256:
        raise ValueError("a part's code is one byte")
    books = first_codebooks(kept, dim, parts, entries)
    for _ in range(rounds):
        books = moved_codebooks(kept, dim, books)
    return books


def vector_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                 scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding",
                 label_col: str = "label") -> DataFrame:
    """Per vector kept: ``vec_id, code, error, label_error, codebooks_sha256``."""
    kept, dim = scaled(vectors, parts, scale, id_col, vec_col, label_col)
    books = train(kept, dim, parts, entries, rounds) if dim else []
    if dim:
        out = materialize(coded(kept, dim, books), "codes")
    else:
        out = kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    # Written, so that both sides of the join are plain shuffles, whose hot partitions Spark splits.
    totals = materialize(out.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    digest = hashlib.sha256(codebooks_text(books).encode()).hexdigest()
    return out.join(totals.withColumnRenamed("label", "of"), out["label"].eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))

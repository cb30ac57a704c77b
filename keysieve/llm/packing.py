"""Best-fit-decreasing packing of token pieces into fixed-length sequences.

Documents are encoded, closed with an end id and, if longer than a sequence,
cut into whole sequences (the first piece takes the rest). Pieces are numbered
when they are written and packed by length only: groups of a bounded number of
pieces, drawn by a hash of the number, so that equal rows are spread like all
others, are packed independently, longest first, each into the open sequence with the least room
that still fits. A segment tree over the remaining capacities (one leaf per
capacity, holding how many open sequences have it) finds that sequence in
log2(capacity) steps. The number of groups grows with the pieces, so no task
grows; a group ends with a few sequences not full, out of thousands.

Defined results: a null or empty text is the end id alone; every row is packed,
rows that repeat an id or have none too; an empty table gives an empty result; other columns are
ignored. ``start`` counts the document's ids before the piece.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keysieve.llm.common import map_batches, texts
from keysieve.llm.tokens import encoder, vocabulary
from keysieve.operators.lineage import materialize

CAPACITY, END_ID = 1024, 2
#: Pieces packed together by one task.
GROUP = 20_000


class OpenBins:
    """Segment tree over capacities 1..n: counts of open bins, tightest fit."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, by: int) -> None:
        i, count = room + self.size, self.count
        while i:
            count[i] += by
            i >>= 1

    def push(self, room: int, bin_id: int) -> None:
        if room:
            self.bins[room].append(bin_id)
            self._add(room, 1)

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Removes and returns ``(room, bin)`` of least room >= need."""
        count, i = self.count, need + self.size
        if not count[i]:
            # Up to the first right neighbour that has an open bin, then down its left side.
            while i > 1 and (i & 1 or not count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if count[2 * i] else 2 * i + 1
        room = i - self.size
        self._add(room, -1)
        return room, self.bins[room].pop()


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """``(bin, offset)`` of each length, packed longest first."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    free, n = OpenBins(capacity), 0
    for k in np.argsort(-lengths, kind="stable"):
        need = int(lengths[k])
        got = free.tightest(need)
        if got is None:
            got, n = (capacity, n), n + 1
        room, at = got
        bins[k], offsets[k] = at, capacity - room
        free.push(room - need, at)
    return bins, offsets


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
           with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: ``doc_id, piece, start, length, ids_crc32`` and, if asked, ``ids``."""
    path, end = path or vocabulary(), np.array([end_id], "<u4").tobytes()

    def start():
        encode = encoder(path).ids

        def cut(docs: list, text: list) -> tuple:
            out: tuple[list, ...] = tuple([] for _ in range(5 + with_ids))
            for doc, t in zip(docs, text, strict=True):
                ids = encode(t) + end
                n, at = len(ids) // 4, 0
                for k, stop in enumerate(range(n % capacity or capacity, n + 1, capacity)):
                    part = ids[4 * at:4 * stop]
                    row = (doc, k, at, stop - at, zlib.crc32(part))
                    for c, v in zip(out, (*row, np.frombuffer(part, "<i4")) if with_ids else row, strict=True):
                        c.append(v)
                    at = stop
            return out

        return cut

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return map_batches(texts(docs, id_col, text_col), schema, start)


def pack(cut: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``cut`` (its columns and ``length``) with ``sequence_id`` and ``offset``."""
    # The numbers are fixed once the rows are written.
    rows = materialize(cut.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    n_groups = max(1, math.ceil(rows.count() / group))

    def packed(g: pa.Table) -> pa.Table:
        # A full order, so that a lost task packs alike when it runs again.
        g = g.sort_by([("length", "descending"), ("__row", "ascending")])
        bins, offsets = best_fit(g["length"].to_numpy(), capacity)
        ids = bins * n_groups + g["__group"].to_numpy()
        return (g.drop_columns(["__row", "__group"]).append_column("sequence_id", pa.array(ids, pa.int64()))
                .append_column("offset", pa.array(offsets, pa.int64())))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return grouped(rows, n_groups).groupBy("__group").applyInArrow(packed, f"{schema}, sequence_id long, offset long")


def grouped(rows: DataFrame, n_groups: int) -> DataFrame:
    """Numbered rows dealt to groups by a hash of their number."""
    return rows.withColumn("__group", F.pmod(F.xxhash64("__row"), F.lit(n_groups)).cast("int"))


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY,
                   end_id: int = END_ID, group: int = GROUP) -> DataFrame:
    """Per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    return pack(pieces(docs, path, capacity, end_id, with_ids=False), capacity, group)


def sequences(docs: DataFrame, packed: DataFrame, path: str | None = None, capacity: int = CAPACITY,
              end_id: int = END_ID) -> DataFrame:
    """The training sequences themselves, ``(sequence_id, ids)``, for documents
    with distinct ids: pieces are encoded again and put in their place."""
    at = packed.select("doc_id", "piece", "sequence_id", "offset")
    cut = pieces(docs, path, capacity, end_id).select("doc_id", "piece", "ids")
    return (cut.join(at, ["doc_id", "piece"]).groupBy("sequence_id")
            .agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
            .select("sequence_id", F.flatten("parts.ids").alias("ids")))

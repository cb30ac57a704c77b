"""Log-likelihood of whole documents under a gated recurrent language model.

Training-fold documents give the token counts and, split over the tasks of the
cluster, train the recurrent model: each task runs truncated backpropagation
over its share of the documents and the tasks' weights are averaged, in
``ROUNDS`` rounds that together see every training document once. Scoring
carries the state through the whole document.

The model predicts each of the ``HEAD`` most frequent words, the end and ``rare``,
which stands for all other words; a rare word's own probability follows from its
count. Classes and clusters of words follow the training vocabulary up to
``HEAD``; a word met ``OWN`` times in training has an input row of its own. So model and unigram base are distributions over the same events: the
known tokens and one unknown word. With D = N + V + 1, the base gives a token
of count c the probability (c + 1) / D.

Counts of the ``HEAD`` most frequent words travel with the task; those of all
others are joined. Both kinds are exact.

Defined results: a null or empty text is the end token alone; a null id is
held out; rows that repeat an id or a text are scored each; with no training
document the base gives every token probability one (D = 1); an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keysieve.llm import gru
from keysieve.llm.common import id_bucket, texts
from keysieve.operators.lineage import materialize

FOLDS, HELD_OUT = 7, 2
#: Words that the model predicts and whose counts travel with the task; classes of
#: the most frequent ones and words in each, the others are the network's tail.
HEAD, CLASSES, PER_CLASS = 65_536, 16, 60
#: Occurrences from which a tail word has its own input row; input kinds of the
#: other words (by their last letters), state size, learning rate.
OWN, KINDS, HIDDEN, RATE = 200, 64, 8, 0.01
#: Weights that travel together from a task to their sum.
BLOCK = 128
#: Bounds of the rounds, in 64ths of the training documents.
ROUNDS = (0, 8, 64)
#: Bytes of text read at a time, for ids and for counts.
READ_BYTES, COUNTED_BYTES = 8 << 20, 24 << 20


class Words:
    """The words of some texts: A-Z lower-cased, cut at ASCII white space.

    ``words`` is an Arrow array, ``cuts[i]:cuts[i + 1]`` are text i's."""

    def __init__(self, rows: list[str]):
        parts = [t.encode() for t in rows]
        raw = np.frombuffer(b"   " + b"\n".join(parts).lower() + b"\n", np.uint8)
        blank = raw == 32
        blank |= (raw - np.uint8(9)) < 5
        first = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
        last = np.flatnonzero(~blank[:-1] & blank[1:])
        offsets = np.zeros(len(first) + 1, np.int32)
        np.cumsum(last - first + 1, out=offsets[1:])
        self.words = pa.Array.from_buffers(pa.binary(), len(first), [
            None, pa.py_buffer(offsets), pa.py_buffer(raw[~blank])])
        ends = np.cumsum([len(p) + 1 for p in parts], dtype=np.int64) + 3
        self.cuts = np.r_[0, np.searchsorted(last, ends)]
        self.raw, self.last = raw, last

    def kinds(self, which: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Numbers of some words from their last three letters."""
        one, two, three = (self.raw[self.last[which] - k].astype(np.int32) for k in (0, 1, 2))
        # What is before a shorter word is blank and counts as none.
        two, three = (np.where((x == 32) | (x >= 9) & (x < 14), 0, x) for x in (two, three))
        return ((one * 31 + two) * 31 + np.where(two > 0, three, 0)) % KINDS


def in_training(id_col: str = "doc_id"):
    return F.coalesce(id_bucket(id_col, FOLDS) != HELD_OUT, F.lit(False))


def _grouped(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Rows of about ``size`` bytes of text (the last column) at a time."""
    for b in batches:
        text = b.column(b.num_columns - 1)
        ends = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < b.num_rows:
            stop = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size)) + 1
            part = b.slice(at, stop - at)
            yield part, part.column(b.num_columns - 1).to_pylist()
            at = stop


def word_counts(train: DataFrame) -> DataFrame:
    """``(word, c)`` over the training texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _grouped(batches, COUNTED_BYTES):
            n = pc.value_counts(Words(rows).words)
            yield pa.RecordBatch.from_arrays([n.field("values"), n.field("counts")], names=["word", "n"])

    return (train.select("text").mapInArrow(count, "word binary, n long")
            .groupBy("word").agg(F.sum("n").alias("c")))


def head_words(counts: DataFrame) -> list[tuple[bytes, int]]:
    """The most frequent words, at most ``HEAD``: all from a count on, so that
    no more than those reach the driver."""
    step = F.floor(F.log2("c") * 16)
    steps = sorted(((r["k"], r["n"]) for r in counts.groupBy(step.alias("k")).agg(F.count(F.lit(1)).alias("n"))
                    .collect()), reverse=True)  # at most 16 rows per power of two
    total, least = 0, None
    for k, n in steps:
        total += n
        if total > HEAD:
            break
        least = k
    if least is None:
        return []
    found = counts.where(step >= least).collect()
    return sorted(((bytes(r["word"]), r["c"]) for r in found), key=lambda x: (-x[1], x[0]))


class Vocabulary:
    """What a task needs to read texts: head counts, ids, totals."""

    def __init__(self, head: list[tuple[bytes, int]], n_train: int, known_words: int, n_words: int):
        self.train_tokens = n_words + n_train
        self.size = known_words + (n_train > 0)
        self.d = self.train_tokens + self.size + 1
        n = CLASSES * PER_CLASS
        tail, tail_at = head[n:], n + 1 + KINDS
        own = sum(c >= OWN for _, c in tail)
        self.sizes = gru.Sizes(tail_at + own, CLASSES + 2, PER_CLASS, HIDDEN, len(tail), tail_at)
        self.inputs = np.arange(tail_at + len(tail), dtype=np.int32)
        self.inputs[tail_at + own:] = self.sizes.rare + Words([" ".join(w.decode() for w, _ in tail[own:])]).kinds()
        self.head = pa.array([w for w, _ in head], pa.binary())
        self.base = np.log10([(c + 1) / self.d for _, c in head])
        self.end_base = math.log10((n_train + 1) / self.d)
        p = np.zeros(n + self.sizes.clusters * gru.GROUPS * gru.PER_GROUP)
        p[:len(head)] = [(c + 1) / self.d for _, c in head]
        end = (n_train + 1) / self.d
        self.rare_mass = max(1 / self.d, 1 - p.sum() - end)
        per = p[:n].reshape(CLASSES, PER_CLASS) + 1e-9
        self.tail_p = p[n:].reshape(-1, gru.GROUPS, gru.PER_GROUP) + 1e-12
        self.class_p = np.r_[per.sum(1), end, self.rare_mass, self.tail_p.sum((1, 2))]
        self.word_p = per / per.sum(1, keepdims=True)

    def initial(self) -> dict[str, np.ndarray]:
        return gru.initial(self.sizes, self.class_p, self.word_p, tail_p=self.tail_p)

    def places(self, words: Words) -> np.ndarray:
        """Place of each word in the head, or -1."""
        found = pc.index_in(words.words, value_set=self.head)
        return found.fill_null(-1).to_numpy(zero_copy_only=False)

    def ids(self, at: np.ndarray, words: Words) -> list[np.ndarray]:
        """Each text's ids, the end included: a head word's own, else its kind."""
        n, s = len(words.cuts) - 1, self.sizes
        out = np.empty(len(at) + n, np.int32)
        own, known = np.where(at < s.n_words, at, at - s.n_words + s.tail_at), at >= 0
        own[~known] = s.rare + words.kinds(~known)
        out[np.arange(len(at)) + np.repeat(np.arange(n), np.diff(words.cuts))] = own
        ends = words.cuts[1:] + np.arange(n)
        out[ends] = self.sizes.end
        return np.split(out, ends[:-1] + 1) if n else []


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(k, tokens, x)``: the sum of each ``k``; ``x`` are 32-bit floats coming, 64-bit going."""
    sums: dict[int, list] = {}
    for b in batches:
        for k, n, x in zip(*(c.to_pylist() for c in b.columns), strict=True):
            own = sums.setdefault(k, [0.0, 0.0])
            own[0] += n
            own[1] += np.frombuffer(x, np.float32).astype(np.float64) * n
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.array([n for n, _ in sums.values()], pa.float64()),
             pa.array([x.tobytes() for _, x in sums.values()], pa.binary())], names=["k", "tokens", "x"])


def train_round(train: DataFrame, v: Vocabulary, p: np.ndarray, like: dict[str, np.ndarray],
                rate: float) -> np.ndarray:
    """Weights after the tasks' passes over ``train``, averaged by their tokens.
    A task sends its changes, without blocks of weights that it left alone."""
    shared = train.sparkSession.sparkContext.broadcast((v, p))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc, start = shared.value
        runner, tokens = gru.Runner(gru.unflat(start, like), voc.sizes, voc.inputs), 0
        for _, rows in _grouped(batches, READ_BYTES):
            w = Words(rows)
            docs = voc.ids(voc.places(w), w)
            del w
            tokens += sum(map(len, docs))
            gru.train(runner, docs, rate)
        if tokens:
            x = gru.flat(runner.p)
            if np.isfinite(x).all():
                x = np.pad(x - start.astype(np.float32), (0, -len(x) % BLOCK)).reshape(-1, BLOCK)
                changed = np.flatnonzero(x.any(1))
                # Block -1 has no weights; it counts the tokens of all tasks.
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.r_[-1, changed]), pa.array(np.full(len(changed) + 1, float(tokens))),
                     pa.array([b"", *(y.tobytes() for y in x[changed])], pa.binary())], names=["k", "tokens", "x"])

    schema = "k long, tokens double, x binary"
    total = train.select("text").mapInArrow(run, schema).repartition("k").mapInArrow(_summed, schema)
    got = {r["k"]: r for r in total.collect()}  # as many values as the model has weights
    if not got:
        return p
    out, tokens = np.pad(p, (0, -len(p) % BLOCK)).reshape(-1, BLOCK), got.pop(-1)["tokens"]
    for k, r in got.items():
        out[k] += np.frombuffer(r["x"], np.float64) / tokens
    return out.ravel()[:len(p)]


def fit(docs: DataFrame, rate: float = RATE):
    """``(vocabulary, weights, counts)`` from the training folds of ``(doc_id, text)``."""
    train = docs.where(in_training())
    counts = materialize(word_counts(train), "word-counts")
    total = counts.agg(F.count(F.lit(1)).alias("v"), F.sum("c").alias("n")).first()
    n_train = train.select("doc_id").count()
    v = Vocabulary(head_words(counts), n_train, total["v"], total["n"] or 0)
    like = v.initial()
    p = gru.flat(like).astype(np.float64)
    share = F.pmod(F.xxhash64(F.lit("round"), "doc_id"), F.lit(ROUNDS[-1]))
    for lo, hi in zip(ROUNDS, ROUNDS[1:], strict=False):
        p = train_round(train.where((share >= lo) & (share < hi)), v, p, like, rate)
    return v, gru.unflat(p, like), counts


def read_scores(docs: DataFrame, v: Vocabulary, weights: dict[str, np.ndarray]) -> DataFrame:
    """Per row: what the model and the head counts say, and the words left."""
    shared = docs.sparkSession.sparkContext.broadcast((v, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc, p = shared.value
        runner = gru.Runner(p, voc.sizes, voc.inputs)
        row = TaskContext.get().partitionId() << 33
        for part, rows in _grouped(batches, READ_BYTES):
            w = Words(rows)
            at = voc.places(w)
            found = at >= 0
            base = np.zeros(len(at))
            base[found] = voc.base[at[found]]
            total = lambda x, cuts=w.cuts: np.diff(np.r_[0.0, np.cumsum(x)][cuts])
            n = np.diff(w.cuts) + 1
            # Of a rare word the model gives the probability of being rare; the rest is its count's.
            model = (gru.log_likelihood(runner, voc.ids(at, w)) / math.log(10)
                     - total(~found) * math.log10(voc.rare_mass))
            left = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(~found)][w.cuts], pa.int32()),
                                            w.words.filter(pa.array(~found)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + len(n))), part.column(0), pa.array(n),
                 pa.array(total(found).astype(np.int64) + int(voc.size > 0)),
                 pa.array(total(base) + voc.end_base), pa.array(model), left],
                names=["row", "doc_id", "n_tokens", "head_known", "head_base", "head_model", "rest"])
            row += len(n)

    return docs.mapInArrow(run, "row long, doc_id long, n_tokens long, head_known long, head_base double, "
                                "head_model double, rest array<binary>")


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE) -> DataFrame:
    """Per row: ``doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score``, both scores log10 probabilities of the whole text."""
    t = texts(docs, id_col, text_col)
    v, weights, counts = fit(t, rate)
    # Written: row numbers are then fixed, whatever is lost later.
    read = materialize(read_scores(t, v, weights), "lm-read")
    rest = read.select("row", F.explode("rest").alias("word")).join(counts, "word", "left")
    logs = rest.groupBy("row").agg(
        F.sum(F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(float(v.d)))).alias("s"), F.count("c").alias("k"))
    zero = F.lit(0)
    return read.drop("rest").join(logs, "row", "left").select(
        "doc_id", (~in_training()).alias("held_out"), "n_tokens",
        (F.col("head_known") + F.coalesce("k", zero)).alias("n_known"),
        F.lit(v.train_tokens).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("s", zero)).alias("base_score"),
        (F.col("head_model") + F.coalesce("s", zero)).alias("score"))

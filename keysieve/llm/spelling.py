"""Spelling variants: words one edit apart, found in a frequency-vector trie.

A word's vector counts its letters by groups; one inserted, deleted or replaced
letter changes one count by one, or one up and another down. The words of a
length are the leaves of a trie whose levels are the successive group counts. A
search goes down the trie depth first with a budget of one letter too many
(surplus) and one too few (deficit), and leaves a branch when its budget is
spent; the words at the leaves it reaches are compared letter by letter.

The top of the trie deals the work: a shard holds the words of one length that
agree in the first few counts, the number of which grows with the vocabulary. A
word visits every shard that its budget lets it reach: of its own length those
with later counts (the other direction is found from the other word), of the
next length all of them. Inside a task the rest of the trie is searched for all
words of the shard at once. A shard with very many words is dealt over tasks,
each comparing one part of its words with one part of its visitors. A task
returns no pairs, but per word the number of near words it met and the best of
them, so a word with many variants costs no more rows than shards it met.

Word counts are combined before they are shuffled, so a word that fills a third
of all text is a few rows. A form has a multiple of its variant's count, so
chains of forms are short; they are followed by doubling.

Defined results: null and empty texts have no words; a null id is an empty text
in the noise hash; rows that repeat an id or a text count again; an empty table
gives an empty result; columns other than the two named are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keysieve.llm.common import ascii_lower, texts
from keysieve.operators.lineage import materialize

LETTERS = r"A-Za-zÀ-ÿ"
MIN_LENGTH, MIN_COUNT, RATIO, NOISE = 7, 2, 10, 31
#: Letter groups, and the most levels of the trie's top (four bits each in a shard's number).
GROUPS, TOP = 16, 6
#: Words that a shard should have, and words or visitors of one task.
SHARD, PART = 20_000, 40_000
#: Pairs compared at a time times their length.
BLOCK = 1 << 23
#: Ranges of at most so many words are compared without going down further.
LEAF = 2


def noisy(word: Column, id_text: Column, every: int) -> Column:
    """``word`` with one letter deleted where ``every`` divides its hash."""
    h = F.crc32(F.concat(id_text, F.lit(":"), word))
    k = F.pmod(h, F.length(word).cast("long")).cast("int")
    return F.when(F.pmod(h, F.lit(every).cast("long")) == 0,
                  F.concat(word.substr(F.lit(1), k), word.substr(k + 2, F.length(word)))).otherwise(word)


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, noise: int | None = None,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n)``: lower-cased letter runs of at least ``min_length`` that
    occur at least ``min_count`` times; with ``noise`` every so many loses a letter."""
    found = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))
    ids = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    w = texts(docs, id_col, text_col).select(ids.alias("id"), F.explode(found).alias("word"))
    w = w.select("id", ascii_lower(F.col("word")).alias("word"))
    if noise:
        w = w.select(noisy(F.col("word"), F.col("id"), noise).alias("word")).where(F.length("word") >= min_length)
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All letters as bytes (every letter is below 256), and the words' lengths."""
    return (np.frombuffer("".join(words).encode("latin-1"), np.uint8),
            np.fromiter(map(len, words), np.int64, len(words)))


def letter_groups(vocab: DataFrame, groups: int = GROUPS) -> np.ndarray:
    """Group of each of 256 letters: the most frequent in the vocabulary lead a
    group each, the others follow in turn. At most 256 counts reach the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, np.int64)
        for b in batches:
            total += np.bincount(letters(b.column(0).to_pylist())[0], minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(total)], names=["letter", "n"])

    counts = np.zeros(256, np.int64)
    for r in vocab.select("word").mapInArrow(count, "letter long, n long").groupBy("letter").agg(F.sum("n").alias("n")).collect():
        counts[r["letter"]] = r["n"]
    out = np.empty(256, np.int64)
    out[np.argsort(-counts, kind="stable")] = np.arange(256) % groups
    return out


def vectors(flat: np.ndarray, size: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """Group counts per word."""
    owner = np.repeat(np.arange(len(size)), size)
    return np.bincount(owner * groups + group[flat], minlength=len(size) * groups).reshape(-1, groups)


def steps(levels: int) -> list[tuple[int, np.ndarray]]:
    """``(by how much longer, change of counts)`` that a word's visits need."""
    one = np.eye(levels, dtype=np.int64)
    zero = np.zeros(levels, np.int64)
    same = [x - y for x in [zero, *one] for y in [zero, *one]]
    later = [d for d in same if d.any() and d[np.flatnonzero(d)[0]] > 0]
    later = list({tuple(d): d for d in later}.values())
    return [(0, zero), *((0, d) for d in later), (1, zero), *((1, d) for d in one)]


def visits(vocab: DataFrame, group: np.ndarray, levels: int, groups: int = GROUPS) -> DataFrame:
    """``(shard, home, word, n)``: each word in its own shard and where it visits."""
    moves = steps(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, size = letters(b.column(0).to_pylist())
            # A count over 15 is 15: words that differ by one still differ by at most one.
            count = np.minimum(vectors(flat, size, group, groups)[:, :levels], 15)
            for k, (longer, d) in enumerate(moves):
                to = count + d
                ok = np.flatnonzero(((to >= 0) & (to <= 15)).all(axis=1))
                shard = size[ok] + longer
                for level in range(levels):
                    shard = shard << 4 | to[ok, level]
                rows = pa.array(ok)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard), pa.array(np.full(len(ok), k == 0)), b.column(0).take(rows), b.column(1).take(rows)],
                    names=["shard", "home", "word", "n"])

    return vocab.select("word", "n").mapInArrow(run, "shard long, home boolean, word string, n long")


class Shard:
    """The words of one length below a node of the trie, and who looks for them.

    ``home`` words are ``length`` long; ``same`` and ``shorter`` (by one) words
    search among them. Words are numbered: same, then shorter."""

    def __init__(self, home: list[str], same: list[str], shorter: list[str], group: np.ndarray, groups: int):
        self.home, self.same, self.shorter = (self._matrix(w) for w in (home, same, shorter))
        counts = [vectors(m.ravel(), np.full(len(m), m.shape[1]), group, groups) for m in (self.home, self.same, self.shorter)]
        # Home words in the order of their vectors: a node of the trie is a range of them.
        self.order = np.lexsort(counts[0].T[::-1])
        self.counts, self.query = counts[0][self.order], np.concatenate(counts[1:])
        self.groups = groups
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting: list[tuple[np.ndarray, int, int]] = []
        self.wait = 0

    @staticmethod
    def _matrix(words: list[str]) -> np.ndarray:
        flat, size = letters(words)
        return flat.reshape(len(words), size[0]) if words else np.zeros((0, 0), np.uint8)

    def near(self) -> tuple[np.ndarray, np.ndarray]:
        """``(searching word, home word)`` of each pair one edit apart."""
        n, m = len(self.same), len(self.shorter)
        if len(self.home) and n + m:
            surplus = np.r_[np.ones(n, bool), np.zeros(m, bool)]
            self._search(0, 0, len(self.home), np.arange(n + m), surplus, np.ones(n + m, bool))
            self._verify()
        none = [np.empty(0, np.int64)]
        return np.concatenate([a for a, _ in self.pairs] or none), np.concatenate([b for _, b in self.pairs] or none)

    def _search(self, level: int, lo: int, hi: int, rows: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> None:
        """Home words ``lo`` to ``hi`` agree in the counts above ``level``;
        ``rows`` may still meet them with what is left of their budgets."""
        while level < self.groups and hi - lo > LEAF:
            here = self.counts[lo:hi, level]
            if here[0] != here[-1]:
                break
            rows, surplus, deficit = self._pay(level, int(here[0]), rows, surplus, deficit)
            if not len(rows):
                return
            level += 1
        if level == self.groups or hi - lo <= LEAF:
            self.waiting.append((rows, lo, hi))
            self.wait += len(rows) * (hi - lo)
            if self.wait * max(1, self.home.shape[1]) > BLOCK:
                self._verify()
            return
        for start, stop in _runs(here):
            left = self._pay(level, int(here[start]), rows, surplus, deficit)
            if len(left[0]):
                self._search(level + 1, lo + start, lo + stop, *left)

    def _pay(self, level: int, count: int, rows, surplus, deficit):
        """Who can go to the branch of ``count``, and what budget is left then."""
        over = self.query[rows, level] - count
        ok = (over == 0) | ((over == 1) & surplus) | ((over == -1) & deficit)
        over = over[ok]
        return rows[ok], surplus[ok] & (over != 1), deficit[ok] & (over != -1)

    def _verify(self) -> None:
        per = max(1, BLOCK // max(1, self.home.shape[1]))
        rows, words, size = [], [], 0
        for r, lo, hi in self.waiting:
            for a in range(0, len(r), max(1, per // (hi - lo))):
                part = r[a:a + max(1, per // (hi - lo))]
                rows.append(np.repeat(part, hi - lo))
                words.append(np.tile(self.order[lo:hi], len(part)))
                size += len(rows[-1])
                if size >= per:
                    self._compare(np.concatenate(rows), np.concatenate(words))
                    rows, words, size = [], [], 0
        if rows:
            self._compare(np.concatenate(rows), np.concatenate(words))
        self.waiting, self.wait = [], 0

    def _compare(self, rows: np.ndarray, words: np.ndarray) -> None:
        same = rows < len(self.same)
        a, b = rows[same], words[same]
        if len(a):
            ok = (self.same[a] != self.home[b]).sum(axis=1) == 1
            self.pairs.append((a[ok], b[ok]))
        a, b = rows[~same], words[~same]
        if len(a):
            short, long = self.shorter[a - len(self.same)], self.home[b]
            # One letter less: a common start and a common end together hold the whole word.
            start = np.concatenate([short != long[:, :-1], np.ones((len(a), 1), bool)], axis=1).argmax(axis=1)
            end = np.concatenate([(short != long[:, 1:])[:, ::-1], np.ones((len(a), 1), bool)], axis=1).argmax(axis=1)
            ok = start + end >= short.shape[1]
            self.pairs.append((a[ok], b[ok]))


def _runs(sorted_values: np.ndarray) -> Iterator[tuple[int, int]]:
    cut = np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1
    return zip(np.r_[0, cut].tolist(), np.r_[cut, len(sorted_values)].tolist(), strict=True)


def dealt(met: DataFrame, part: int = PART) -> DataFrame:
    """``met`` with ``(i, j, searches, target)``: the rows of one task. In a
    shard of over ``part`` rows the searching words are dealt by ``i``, its home
    words by ``j``, and every ``i`` meets every ``j``."""
    one = F.lit(0).cast("long")
    sizes = met.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.count_if("home").alias("homes"))
    hot = materialize(sizes.where(F.col("rows") > part).select(
        F.col("shard").alias("hot"), F.ceil(F.col("rows") / part).alias("ni"),
        F.ceil(F.greatest("homes", F.lit(1)) / part).alias("nj")), "hot-shards")
    cols = ["shard", "home", "word", "n"]
    cold = met.select(*cols, one.alias("i"), one.alias("j"), F.lit(True).alias("searches"), F.col("home").alias("target"))
    if hot.isEmpty():
        return cold
    cold = cold.join(hot, F.col("shard") == F.col("hot"), "left_anti")
    h, own = met.join(hot, F.col("shard") == F.col("hot")), F.xxhash64("word")
    each = lambda n: F.explode(F.sequence(one, F.col(n) - 1))
    search = h.select(*cols, F.pmod(own, F.col("ni")).alias("i"), each("nj").alias("j"),
                      F.lit(True).alias("searches"), F.lit(False).alias("target"))
    target = h.where("home").select(*cols, each("ni").alias("i"), F.pmod(own, F.col("nj")).alias("j"),
                                    F.lit(False).alias("searches"), F.lit(True).alias("target"))
    return cold.unionByName(search).unionByName(target)


def near_words(runs: DataFrame, group: np.ndarray, levels: int, groups: int = GROUPS) -> DataFrame:
    """``(word, n, n_near, form, form_n)`` per row of ``runs``: how many near
    words it met in its task, and the most frequent of them (ties: the least)."""
    schema = "word string, n long, n_near long, form string, form_n long"

    def run(g: pa.Table) -> pa.Table:
        word, n = np.array(g["word"].to_pylist(), object), g["n"].to_numpy()
        home, searches, target = (g[c].to_numpy(zero_copy_only=False) for c in ("home", "searches", "target"))
        size = np.fromiter(map(len, word), np.int64, len(word))
        length = g["shard"][0].as_py() >> 4 * levels  # visitors may be shorter by one
        among, same, shorter = (np.flatnonzero(x) for x in (target, searches & (size == length), searches & (size < length)))
        a, b = Shard(list(word[among]), list(word[same]), list(word[shorter]), group, groups).near()
        a, b = np.concatenate([same, shorter])[a], among[b]
        # Home words find each other from both sides; what a visitor finds counts for both.
        visit = ~home[a]
        a, b = np.concatenate([a, b[visit]]), np.concatenate([b, a[visit]])
        by_rank = np.lexsort((word.astype(str), -n))
        rank = np.empty(len(word), np.int64)
        rank[by_rank] = np.arange(len(word))
        best = np.full(len(word), len(word))
        np.minimum.at(best, a, rank[b])
        met = best < len(word)
        best = by_rank[np.where(met, best, 0)]
        return pa.table([g["word"], g["n"], pa.array(np.bincount(a, minlength=len(word))),
                         pa.array(word[best], pa.string(), mask=~met), pa.array(n[best], mask=~met)],
                        names=["word", "n", "n_near", "form", "form_n"])

    return runs.groupBy("shard", "i", "j").applyInArrow(run, schema)


def with_roots(forms: DataFrame, rounds: int = 64) -> DataFrame:
    """``forms`` with ``root``: the last word on the way along forms. Each round
    doubles the length of the way that ``up`` has gone."""
    up = materialize(forms.where("form is not null").select("word", F.col("form").alias("up")), "up")
    for _ in range(rounds):
        ahead = up.select(F.col("word").alias("up"), F.col("up").alias("further"))
        step = up.join(ahead, "up", "left")
        if step.where("further is not null").isEmpty():
            break
        up = materialize(step.select("word", F.coalesce("further", "up").alias("up")), "up")
    return forms.join(up, "word", "left").withColumn("root", F.coalesce("up", "word")).drop("up")


def variants(vocab: DataFrame, ratio: int = RATIO, groups: int = GROUPS, shard: int = SHARD, part: int = PART) -> DataFrame:
    """Per word of ``vocab(word, n)``, a table: ``word, n, n_near, form, form_n,
    root``. A word's form is the most frequent word one edit away, if it is at
    least ``ratio`` (2 or more) times as frequent."""
    if ratio < 2:
        raise ValueError("forms must be more frequent than their variants")
    levels = min(TOP, max(0, round(math.log(max(1, vocab.count()) / shard, 4))))
    group = letter_groups(vocab, groups)
    met = materialize(visits(vocab, group, levels, groups), "visits")
    near = near_words(dealt(met, part), group, levels, groups)
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("word"))))
    total = near.groupBy("word").agg(F.first("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    is_form = -F.col("best.n") >= ratio * F.col("n")
    forms = total.select("word", "n", "n_near", F.when(is_form, F.col("best.word")).alias("form"),
                         F.when(is_form, -F.col("best.n")).alias("form_n"))
    return with_roots(materialize(forms, "forms"))


def spelling_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO,
                      noise: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``variants`` of the words of ``docs``."""
    vocab = vocabulary(docs, min_length, min_count, noise, id_col, text_col)
    return variants(materialize(vocab, "vocabulary"), ratio)

"""Toxicity scores that see through disguised spelling.

Disguised words (look-alike digits and signs, letters set apart, letters
repeated) are read as a noisy channel: every written character could stand for
some letters, which gives a lattice, and a Viterbi search under a character
trigram model finds the likeliest words. Signs at a token's ends are read both
as marks and as letters, tokens of signs alone as letters unless they are a
number, and letters set apart as one word or several. A ``*`` hides a vowel or
nothing, so words masked beyond that (``sh**``) are not found. The trigram model is counted over all
documents. Restored words join the plain ones, and the text is scored by the
marks it holds: words and word beginnings that labelled toxic documents hold
significantly more often than clean ones (a binomial test corrected for the
number of marks tested, so the rule is the same at every size). A text's score
is the noisy-or of its marks' smoothed rates, else the rate of texts without.

Marks are learned from labelled documents of the training folds only, at most
about ``SAMPLE`` of them (drawn by a hash). Of near-copies with one label, found
by MinHash keys and verified over all their five-word shingles (half of which
must be common, as in copies of one original), one counts, so that a text with
thousands of copies does not outweigh the others; texts that share a header or
a passage each count. Label, language, source and id are
never inputs of a score.

Defined results: a null or empty text has no marks and gets that base score; a
null id is held out; rows that repeat an id are scored each; of labels that
disagree the toxic one counts, null labels none; without labelled rows of both
kinds all scores are the prior; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keysieve.llm.common import id_bucket, map_batches, texts
from keysieve.llm.decontam import SHINGLE, shingle_hashes, words
from keysieve.operators.lineage import materialize

FOLDS, HELD_OUT, THRESHOLD = 3, 1, 0.7
#: Labelled documents that marks are learned from.
SAMPLE = 40_000
#: Least share of common shingles inside a family; keys by which its members are found. Two texts
#: that are each 0.8-near to one original, which need not be labelled, have half in common or more.
SAME, BANDS = 0.5, 4
#: False marks expected in all; least rate of toxic documents among those with the mark.
FALSE_MARKS, MIN_RATE = 0.01, 0.9
PREFIXES = (4, 5, 6, 7, 8)

#: Letters that a written sign may stand for.
LOOKS_LIKE = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b",
              "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e"}
#: Signs set between letters, which stand for nothing or hide a vowel.
BETWEEN = {"*": ("", *"aeiou"), **{c: ("",) for c in ".-_~'`,:/\\#%&=?^"}}
REPLACED, HIDDEN, REPEATED = math.log(0.1), math.log(0.02), math.log(0.3)

WORD = regex.compile(r"[^\W\d_]+")
EDGE = ".,;:?!\"'()[]{}<>&%#~-_=*"
#: Without the signs that may stand for a letter.
PLAIN_EDGE = "".join(c for c in EDGE if c not in LOOKS_LIKE and c != "*")
#: Numbers, prices, times and the like are not read as letters.
NUMBER = regex.compile(r"[-+$€(\[#~<>=.'\"]*\d+(?:[-.,:/()+x*']+\d+)*[-+%$€)\].,;:!?*'\"]*")
#: Letters of a word set apart, where others follow; single characters in a row, some of them wider apart.
LONGEST, SPACED, GAP = 16, regex.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)"), regex.compile(r"\s{2,}")

TRIPLE = regex.compile(r"([^\W\d_])\1\1")

LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿ"
#: 0: between words; 1..n: letters; the last: any other letter.
N_CLASSES = len(LETTERS) + 2
CLASS = {c: i + 1 for i, c in enumerate(LETTERS)}
#: Tokens remembered by a worker; characters whose trigrams are counted at once.
REMEMBERED, COUNTED_CHARS = 400_000, 500_000


def _class_table() -> np.ndarray:
    """Class of a UTF-16 unit. Halves of a pair count as other letters."""
    t = np.zeros(1 << 16, np.int32)
    for i in range(1 << 16):
        if 0xD800 <= i < 0xE000 or chr(i).isalpha():
            t[i] = CLASS.get(chr(i), N_CLASSES - 1)
    return t


def count_trigrams(t: DataFrame) -> np.ndarray:
    """Character-class trigram counts over all texts, ``[a, b, c]``."""
    n = N_CLASSES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, cls = np.zeros(n ** 3, np.int64), _class_table()
        for b in batches:
            rows = b.column(0).to_pylist()
            at = 0
            while at < len(rows):  # many short texts at a time, apart by two blanks
                stop, size = at, 0
                while stop < len(rows) and (stop == at or size < COUNTED_CHARS):
                    size, stop = size + len(rows[stop]), stop + 1
                units = "  ".join(["", *rows[at:stop], ""]).lower().encode("utf-16-le", "surrogatepass")
                c = cls[np.frombuffer(units, "<u2")]
                total += np.bincount((c[:-2] * n + c[1:-1]) * n + c[2:], minlength=n ** 3)
                at = stop
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["k", "n"])

    summed = t.select("text").mapInArrow(count, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))
    out = np.zeros(n ** 3)
    for k, v in summed.collect():  # at most N_CLASSES cubed rows, whatever the corpus
        out[k] = v
    return out.reshape(n, n, n)


def language_model(counts: np.ndarray, weight: float = 5.0) -> np.ndarray:
    """Natural-log probabilities of c after a, b, smoothed by shorter contexts."""
    tri, bi = counts, counts.sum(0)
    uni = bi.sum(0)
    p = (uni + 1) / (uni.sum() + len(uni))
    p = (bi + weight * p) / (bi.sum(1, keepdims=True) + weight)
    return np.log((tri + weight * p[None]) / (tri.sum(2, keepdims=True) + weight)).astype(np.float32)


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """Per place of a lower-cased token, what it may stand for and at what cost."""
    out: list[list[tuple[str, float]]] = []
    for run in regex.finditer(r"(?s)(.)\1*", token):
        c, n = run[1], len(run[0])
        if c in LOOKS_LIKE:
            one = [(x, REPLACED) for x in LOOKS_LIKE[c]]
        elif c in BETWEEN:
            one = [(x, HIDDEN if x else REPLACED) for x in BETWEEN[c]]
        elif c.isalpha():
            one = [(c, 0.0)]
        else:
            one = [("", REPLACED)]
        if n >= 3:  # a repeated letter stands for one or two
            out.append([(x * k, cost + REPEATED) for x, cost in one for k in ((1, 2) if x else (1,))])
        else:
            out.extend([one] * n)
    return out


def restore(token: str, lm: list, best: int = 3, several: bool = False) -> list[str]:
    """The likeliest words behind a token, by Viterbi search over the lattice;
    the state is the last two character classes, ``lm[a][b][c]`` a log-probability.
    With ``several``, a word may end after any place."""
    other = N_CLASSES - 1
    states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    places = lattice(token)
    if several:
        places = [x for place in places for x in (place, [("", 0.0), (" ", 0.0)])][:-1]
    for options in places:
        new: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a0, b0), (score, path) in states.items():
            for letters, cost in options:
                a, b, s = a0, b0, score + cost
                for c in letters:
                    k = 0 if c == " " else CLASS.get(c, other)
                    s += lm[a][b][k]
                    a, b = b, k
                if (a, b) not in new or new[a, b][0] < s:
                    new[a, b] = (s, (path, letters))
        states = new
    ends = sorted(((s + lm[a][b][0], path) for (a, b), (s, path) in states.items()),
                  key=lambda x: -x[0])[:best]
    words = []
    for _, path in ends:
        parts = []
        while path:
            path, letters = path
            parts.append(letters)
        words.extend("".join(reversed(parts)).split())
    return words


class Remembering(dict):
    """A bounded table of what ``read(key)`` gave."""

    def __init__(self, read):
        super().__init__()
        self.read = read

    def __missing__(self, key: str):
        got = self.read(key)
        if len(key) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[key] = got
        return got


class Reader:
    """Words of lower-cased tokens, plain and restored."""

    def __init__(self, lm: np.ndarray):
        self.lm = lm.tolist()
        self.known = Remembering(self.read)

    def read(self, token: str) -> tuple[str, ...]:
        core, wide = token.strip(EDGE), token.strip(PLAIN_EDGE)
        # A letter can only stand three times where two or more letters repeat.
        triple = len(set(core)) <= len(core) - 2 and TRIPLE.search(core)
        if core.isalpha() and not triple and wide == core:
            return (core,)
        plain = WORD.findall(token)
        if not plain:  # signs and digits alone may spell a word of three letters or more
            signs = sum(c in LOOKS_LIKE for c in wide) > 2 and len(set(wide)) > 1 and not NUMBER.fullmatch(token)
            return tuple({*restore(wide, self.lm), *restore(core, self.lm)}) if signs else ()
        found = {*plain}
        if triple or any(c in LOOKS_LIKE or c in BETWEEN for c in core):
            found.update(restore(core, self.lm))
        if wide != core:  # signs at the ends may be letters as well as marks
            for x in {wide, wide.rstrip(EDGE), wide.lstrip(EDGE)} - {core}:
                found.update(restore(x, self.lm))
        return tuple(found)

    def spaced(self, tokens: list[str], text: str) -> set[str]:
        """Words restored from three or more single characters in a row. The
        first and the last may be a word of its own ("a l o s e r"). Words end
        where the gap is wider than one, where the search finds it likeliest, and
        at any place up to ``LONGEST`` from an end ("y o u i d i o t")."""
        single = np.fromiter(map(len, tokens), np.int64, len(tokens)) == 1
        edge = np.flatnonzero(np.diff(np.r_[False, single, False])).tolist()
        runs = [(a, b) for a, b in zip(edge[::2], edge[1::2], strict=True) if b - a > 2]
        found = {w for a, b in runs
                 for c, d in ((a, b), (a + 1, b), (a, b - 1), (a + 1, b - 1)) if d - c > 2
                 for w in restore("".join(tokens[c:d]), self.lm)}
        for a, b in runs:
            run = "".join(tokens[a:b])
            if any(map(str.isalpha, run)):
                found.update(restore(run, self.lm, several=True))
                for k in range(3, min(LONGEST, len(run) - 1) + 1):
                    found.update(restore(run[:k], self.lm) + restore(run[-k:], self.lm))
        if runs:
            for run in SPACED.findall(text):
                for part in GAP.split(run) if GAP.search(run) else ():
                    found.update(restore("".join(part.split()), self.lm))
        return found

    def words(self, text: str) -> set[str]:
        """Distinct words of a text."""
        text = text.lower()
        tokens = text.split()
        return self.spaced(tokens, text).union(*map(self.known.__getitem__, set(tokens)))


def marks_of(word: str) -> list[str]:
    """A word and its beginnings, told apart by a trailing hyphen."""
    return [word, *(word[:k] + "-" for k in PREFIXES if len(word) > k)]


@dataclass
class Model:
    lm: np.ndarray
    marks: dict[str, float]
    base: float

    def score(self, batch: pd.Series) -> pd.Series:
        if not hasattr(self, "_reader"):
            self._reader = Reader(self.lm)
            self._shortest = min(map(len, self.marks), default=1)
            self._starts = {m[:self._shortest] for m in self.marks}
            self._known = Remembering(lambda token: self._marks(self._reader.read(token)))
        out = []
        for text in batch:
            text = (text or "").lower()
            tokens = text.split()
            found = set().union(*filter(None, map(self._known.__getitem__, set(tokens))),
                                self._marks(self._reader.spaced(tokens, text)))
            clean = 1.0 - self.base
            for m in sorted(found):
                clean *= 1.0 - self.marks[m]
            out.append(1.0 - clean)
        return pd.Series(out, dtype="float64")

    def _marks(self, words) -> tuple[str, ...]:
        """Marks that some of the words have."""
        k, starts, marks = self._shortest, self._starts, self.marks
        return tuple(m for w in words if w[:k] in starts for m in marks_of(w) if m in marks)

    def column(self, spark, text: Column) -> Column:
        """The score of a text column."""
        shared = spark.sparkContext.broadcast(self)
        return F.pandas_udf(lambda s: shared.value.score(s), "double")(text)


def family_keys(found: DataFrame) -> DataFrame:
    """``(row, toxic, key)``: ``BANDS`` keys of each row of ``found(row, toxic,
    h)``, a non-empty array of shingle hashes: pairs of MinHash values."""
    draw = np.random.default_rng(7)
    factors, shifts = (draw.integers(1, 1 << 63, 2 * BANDS, dtype=np.uint64) for _ in range(2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(2)
            h = lists.flatten().to_numpy().view(np.uint64)
            starts = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
            for k in range(BANDS):
                key = np.zeros(len(starts), np.uint64)
                for j in (2 * k, 2 * k + 1):
                    x = (h ^ shifts[j]) * (factors[j] | np.uint64(1))
                    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                    key = (key ^ np.minimum.reduceat(x, starts)) * (factors[j] | np.uint64(1)) if len(starts) else key
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array((key + np.uint64(k)).view(np.int64))],
                                                 names=["row", "toxic", "key"])

    return found.select("row", "toxic", "h").mapInArrow(run, "row long, toxic int, key long")


def near_copies(found: DataFrame) -> DataFrame:
    """Rows of the table ``found(row, toxic, h)`` that are near-copies, by all
    their shingles, of a row of the same label and a smaller number. Rows that
    share a key are compared with the least of them only: a key that unlike
    texts share (a header's) drops none, and no group is compared pair by pair."""
    keyed = materialize(family_keys(found), "family-keys")
    first = keyed.groupBy("key", "toxic").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    pairs = keyed.join(first, ["key", "toxic"]).where("row <> first").select("row", "first").distinct()
    one, other = found.select("row", "h"), found.select(F.col("row").alias("first"), F.col("h").alias("g"))
    both = F.size(F.array_intersect("h", "g"))
    return (pairs.join(one, "row").join(other, "first")
            .where(both >= SAME * (F.size("h") + F.size("g") - both)).select("row").distinct())


def training_ids(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``(doc_id, toxic)``: training-fold labelled documents, at most about
    ``sample``, without verified near-copies of others with the same label."""
    lab = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
           .dropna().where(id_bucket("doc_id", FOLDS) != HELD_OUT)
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    lab = materialize(lab, "labels")
    n = lab.count()
    if n > sample:
        share = int(sample / n * (1 << 20))
        lab = lab.where(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 20)) < share)
    # Broadcast: at most about ``sample`` rows of an id and a flag.
    # The words are a column of their own: inside the lambda they would be cut again per shingle.
    found = texts(docs).join(F.broadcast(lab), "doc_id").select("doc_id", "toxic", words(F.col("text")).alias("w"))
    h = F.array_distinct(shingle_hashes(F.col("w"), SHINGLE))
    # Texts without words are copies of each other. Written, so the numbers stay.
    found = materialize(found.select("doc_id", "toxic", F.when(F.size("w") > 0, h).otherwise(F.array(F.lit(0).cast("long"))).alias("h"))
                        .withColumn("row", F.monotonically_increasing_id()), "shingles")
    gone = materialize(near_copies(found), "near-copies")
    return found.join(gone, "row", "left_anti").select("doc_id", "toxic").distinct()


def count_marks(t: DataFrame, lm: np.ndarray) -> DataFrame:
    """``t(text, toxic)`` -> per mark ``(mark, toxic, clean)`` documents."""
    shared = t.sparkSession.sparkContext.broadcast(lm)

    def start():
        reader = Reader(shared.value)

        def step(text: list, toxic: list) -> tuple:
            both = (Counter(), Counter())
            for x, y in zip(text, toxic, strict=True):
                both[y > 0].update({m for w in reader.words(x) for m in marks_of(w)})
            marks = list(both[0].keys() | both[1].keys())
            return marks, [both[1][m] for m in marks], [both[0][m] for m in marks]

        return step

    part = map_batches(t, "mark string, toxic long, clean long", start)
    return part.groupBy("mark").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Character model over all ``docs``; marks from the labelled sample."""
    t = texts(docs)
    lm = language_model(count_trigrams(t))
    ids = materialize(training_ids(docs, labels, sample), "training-ids")
    kinds = {r["toxic"] > 0: r["count"] for r in ids.groupBy("toxic").count().collect()}
    n_toxic, n_clean = kinds.get(True, 0), kinds.get(False, 0)
    prior = (n_toxic + 0.5) / (n_toxic + n_clean + 1)
    if not n_toxic or not n_clean:
        return Model(lm, {}, prior)
    train = t.join(F.broadcast(ids), "doc_id").select("text", "toxic")
    marks = materialize(count_marks(train, lm), "marks")
    # Log-likelihood ratio (times n) that a mark's share of toxic documents is the prior.
    n, share = F.col("toxic") + F.col("clean"), F.col("toxic") / (F.col("toxic") + F.col("clean"))
    side = lambda k, p, q: F.when(k > 0, k * F.log(p / q)).otherwise(F.lit(0.0))
    gain = side(F.col("toxic"), share, F.lit(prior)) + side(F.col("clean"), 1 - share, F.lit(1 - prior))
    need = F.log(F.lit(max(1, marks.count()) / FALSE_MARKS))
    rate = (F.col("toxic") + 0.5) / (n + 1)
    told = marks.where((gain > need) & (rate >= MIN_RATE)).select("mark", rate.alias("rate"))
    # Some of the words of at most ``sample`` documents.
    lexicon = {r["mark"]: r["rate"] for r in told.collect()}
    # Rate of toxic documents among the training documents without a mark.
    model = Model(lm, lexicon, 0.0)
    # Summed, not filtered: a filter on the score would be pushed below the join, to all documents.
    unmarked = F.col("s") == 0
    bare = train.select("toxic", model.column(docs.sparkSession, F.col("text")).alias("s")).agg(
        F.count_if(unmarked).alias("n"), F.sum(F.when(unmarked, F.col("toxic"))).alias("k")).first()
    return Model(lm, lexicon, ((bare["k"] or 0) + 0.5) / (bare["n"] + 1))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: ``doc_id, held_out, score, predicted``."""
    t = texts(docs)
    s = t.select("doc_id", F.coalesce(id_bucket("doc_id", FOLDS) == HELD_OUT, F.lit(True)).alias("held_out"),
                 model.column(docs.sparkSession, F.col("text")).alias("score"))
    return s.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, all columns."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.where(model.column(docs.sparkSession, text) < threshold)

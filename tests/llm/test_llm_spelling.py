import random
import re
import zlib

import numpy as np
import pytest

from keysieve.llm import spelling as S

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def edits(w):
    return {(i, w[:i] + w[i + 1:]) for i in range(len(w))}


def brute(rows, noise=31, min_length=7, min_count=2, ratio=10):
    n = {}
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = run.translate(LOWER)
            if noise:
                h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
                if h % noise == 0:
                    k = h % len(w)
                    w = w[:k] + w[k + 1:]
            n[w] = n.get(w, 0) + 1
    n = {w: c for w, c in n.items() if c >= min_count and len(w) >= min_length}
    near = {w: {v for v in n if v != w and (edits(w) & edits(v) or w in {x for _, x in edits(v)} or v in {x for _, x in edits(w)})}
            for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect()), key=str)


@pytest.fixture(scope="module")
def wordy():
    """Documents of words that are variants of a few, in steep frequencies."""
    r = random.Random(5)
    letters = "abcdefgàéÿß÷z"
    base = ["".join(r.choice(letters) for _ in range(r.randint(6, 11))) for _ in range(40)]

    def edit(w):
        k = r.randrange(len(w))
        return r.choice([w[:k] + w[k + 1:], w[:k] + r.choice(letters) + w[k:], w[:k] + r.choice(letters) + w[k + 1:]])

    pool = []
    for w in base:
        v, c = w, r.choice([3, 40, 400])
        while c:
            pool += [v] * c
            v, c = edit(v), c // r.choice([4, 10, 13])
    r.shuffle(pool)
    rows = [(i, " ".join(pool[k:k + 50])) for i, k in enumerate(range(0, len(pool), 50))]
    return rows + [(None, rows[0][1]), (0, rows[0][1]), (0, None), (1, ""), (2, "ABCDEFG'abcdefg-Abcdefgh ÀBCDEFG àbcdefg")]


def test_words_of_all_kinds(documents, wordy):
    want = brute(wordy)
    assert any(r[5] not in (r[0], r[3]) for r in want), "a chain of forms is needed"
    assert got(S.spelling_variants(documents(wordy), noise=31)) == want
    assert got(S.spelling_variants(documents(wordy), min_length=5, min_count=1, ratio=3)) == brute(wordy, None, 5, 1, 3)


def test_any_depth_of_shards_and_dealt_shards_give_the_same(documents, spark, wordy):
    vocab = S.materialize(S.vocabulary(documents(wordy), noise=31), "vocabulary").coalesce(1)
    want = brute(wordy)
    for shard, part in ((10, 60), (10 ** 6, 25)):
        assert got(S.variants(vocab, shard=shard, part=part)) == want, (shard, part)


def test_one_letter_words_and_very_long_ones(documents):
    long = "ab" * 4000
    rows = [(1, f"{long} {long} {long[:-1]} {long[:-1]} {long}c {long}c a a b b ab ab ba ba aab aab " + "q " * 30),
            (2, "q" * 300 + " " + "q" * 300 + " " + "q" * 299 + " " + "q" * 299)]
    assert got(S.spelling_variants(documents(rows), min_length=1)) == brute(rows, None, 1)


def test_odd_rows_and_empty_table(documents, odd_rows):
    assert got(S.spelling_variants(documents(odd_rows), noise=31)) == brute(odd_rows)
    out = S.spelling_variants(documents([]))
    assert out.columns == ["word", "n", "n_near", "form", "form_n", "root"] and out.isEmpty()


def test_search_leaves_the_trie_early():
    r = random.Random(2)
    words = sorted({"".join(r.choice("etaoinshrd") for _ in range(6)) for _ in range(900)})
    group = np.arange(256) % S.GROUPS
    shard = S.Shard(words, words, [], group, S.GROUPS)
    compared = []
    shard._compare = lambda a, b, own=shard._compare: (compared.append(len(a)), own(a, b))
    a, b = shard.near()
    want = {(v, w) for v in words for w in words if sum(x != y for x, y in zip(v, w)) == 1}
    assert {(words[i], words[j]) for i, j in zip(a, b)} == want
    assert sum(compared) < len(words) ** 2 / 10


def test_a_word_visits_later_shards_only():
    moves = S.steps(3)
    same = [tuple(d) for longer, d in moves if not longer]
    assert len(same) == 1 + (6 + 6) // 2 and len(set(same)) == len(same)
    assert all(tuple(-x for x in d) not in same for d in same if any(d))
    assert sum(1 for longer, _ in moves if longer) == 4

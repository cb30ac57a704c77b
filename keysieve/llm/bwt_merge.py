"""Merging Burrows-Wheeler transforms of shards by interleave refinement.

Strings are taken as cyclic and read in wide letters of ``LETTER`` bytes, so a
suffix is compared by ``DEPTH`` letters. A shard's transform lists, for its
suffixes in sorted order, the letter before each. To merge shards, only the
interleave is kept: which shard the next suffix comes from. Starting from the
shards one after the other (suffixes compared by no letter), a pass hands every
suffix's preceding letter out in the order so far, stably; afterwards the
interleave is right for one letter more. No suffix of one shard is compared
with one of another. The pass at which two neighbours part is their common
prefix in letters, and runs that never part are the repeated intervals.
"""

from __future__ import annotations

import numpy as np

#: Bytes of a letter, letters compared; together the length of a repeat.
LETTER, DEPTH = 10, 5
LENGTH = LETTER * DEPTH


def _order(key: np.ndarray) -> np.ndarray:
    """Stable order of small non-negative numbers."""
    n = len(key)
    return (np.sort(key.astype(np.uint64) << np.uint64(32) | np.arange(n, dtype=np.uint64))
            & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _dense(key: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Rank of each key among the distinct ones, given the sorted order."""
    s = key[order]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(np.r_[False, s[1:] != s[:-1]])
    return rank


def letters(text: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Rank of the wide letter that starts at each byte; ``following[p]`` is
    the byte position after p in p's (cyclic) string."""
    word = np.zeros(len(text), np.uint64)
    p = np.arange(len(text))
    for _ in range(8):
        word = word << np.uint64(8) | text[p]
        p = following[p]
    rank = _dense(word, np.argsort(word))
    for _ in range(8, LETTER):
        rank = rank << 8 | text[p]
        p = following[p]
    return _dense(rank, np.argsort(rank))


def shard_order(letter: np.ndarray, skip: np.ndarray) -> np.ndarray:
    """Positions of one shard sorted by ``DEPTH`` letters; ``skip[p]`` is one
    letter further on. The letters compared double while they can."""
    rank, done, step = letter, 1, skip
    while 2 * done <= DEPTH:
        key = rank * len(rank) + rank[step] if done > 1 else rank * (int(letter.max()) + 1) + rank[step]
        rank, step, done = _dense(key, np.argsort(key)), step[step], 2 * done
    while done < DEPTH:
        key = rank * (int(letter.max()) + 1) + letter[step]
        rank, step, done = _dense(key, np.argsort(key)), skip[step], done + 1
    return _order(rank)


def merged(text: np.ndarray, bounds: np.ndarray, shards: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(positions, common)`` of all suffixes in merged order. ``bounds`` are
    the strings' ends (first 0), ``shards`` indices into ``bounds`` at which a
    shard starts (first 0, last the number of strings). ``common[i]`` is how
    many letters, up to ``DEPTH``, suffix i shares with the one before it."""
    n = len(text)
    at = np.arange(n)
    size = np.diff(bounds)
    first = np.repeat(bounds[:-1], size)
    within = at - first
    length = np.repeat(size, size)
    following = np.where(within + 1 < length, at + 1, first)
    skip = first + (within + LETTER) % length
    before = first + (within - LETTER) % length
    letter = letters(text, following)

    cuts = bounds[shards]
    suffixes = np.concatenate([lo + shard_order(letter[lo:hi], skip[lo:hi] - lo)
                               for lo, hi in zip(cuts, cuts[1:])]) if n else at
    transform = letter[before[suffixes]]
    source = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))

    interleave, block = source.copy(), np.zeros(n, np.int64)
    common = np.full(n, DEPTH, np.int64)
    for depth in range(DEPTH):
        taken = np.empty(n, np.int64)
        taken[_order(interleave)] = transform  # each shard's letters in its own order
        order = _order(taken)
        interleave, block, taken = interleave[order], block[order], taken[order]
        parts = np.r_[True, (taken[1:] != taken[:-1]) | (block[1:] != block[:-1])] if n else taken
        common[(common == DEPTH) & parts] = depth
        block = np.cumsum(parts)
    out = np.empty(n, np.int64)
    out[_order(interleave)] = suffixes
    return out, common

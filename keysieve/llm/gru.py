"""A small gated recurrent language model in numpy.

Frequent words are factored into classes: a softmax over classes, then one inside
the class. The tail of less frequent words is factored once more: clusters, which
are classes too, then groups of a cluster, then words of a group; a step learns
only the groups it meets. A unit's input weights are a row per input id, so no embedding product
is needed. Documents run side by side in lanes, longest first, so that at every
step the lanes still running are a prefix; in scoring, a lane takes one document after
the other, each from a state of zeros. States are carried from window to window, and
gradients stop at the window's edge.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

WINDOW, LANES = 32, 512
#: Tokens of a window at least, while its documents last: where few lanes run, windows are longer.
LEARNED, SCORED = 4096, 32768
#: Largest change of a logarithm by the states that needs no care for overflow.
STEEP = 60
#: Tokens computed at a time, which then stay in the cache.
BLOCK = 1024
#: Tokens of a group above which it is a product of its own; smaller groups go by their size.
MANY = 12
NAMES = ("x", "u", "cw", "cb", "ww", "wb")
NONE = np.zeros(0, np.int64)
#: Groups of a cluster of tail words, words of a group.
GROUPS, PER_GROUP = 128, 16


@dataclass
class Sizes:
    """Targets: ``per_class`` word ids in each class, then the end, then
    ``rare`` (every other word); end and rare are classes of one id. Input ids
    from ``rare`` on are kinds of rare words, ``n_in`` in all. Ids from
    ``tail_at`` on are ``tail`` words more, targets after ``rare``."""
    n_in: int
    n_classes: int
    per_class: int
    hidden: int
    tail: int = 0
    tail_at: int = 0

    @property
    def n_words(self) -> int:
        return (self.n_classes - 2) * self.per_class

    @property
    def end(self) -> int:
        return self.n_words

    @property
    def rare(self) -> int:
        return self.n_words + 1

    @property
    def clusters(self) -> int:
        return -(-self.tail // (GROUPS * PER_GROUP))

    def targets(self, y: np.ndarray) -> np.ndarray:
        known = np.minimum(y, self.rare)
        return np.where(y >= self.tail_at, y - self.tail_at + self.rare + 1, known) if self.tail else known


def initial(s: Sizes, class_p: np.ndarray, word_p: np.ndarray, seed: int = 7,
            tail_p: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """Output weights are zero and biases log-probabilities, so that training
    starts from the unigram model. ``word_p[c, w]`` sums to one in each class;
    ``tail_p[c, g, w]`` are the tail's, in any unit."""
    rng, h = np.random.default_rng(seed), s.hidden
    p = {"x": rng.normal(0, 0.5, (s.n_in, 3 * h)), "u": rng.normal(0, h ** -0.5, (h, 3 * h)),
         "cw": np.zeros((h, s.n_classes + s.clusters)), "cb": np.log(class_p),
         "ww": np.zeros((s.n_classes - 2, h, s.per_class)), "wb": np.log(word_p)}
    p["x"][:, :h] += 1.0  # a state that lasts
    if s.tail:
        group_p = tail_p.sum(2)
        p |= {"gw": np.zeros((s.clusters, h, GROUPS)), "gb": np.log(group_p / group_p.sum(1, keepdims=True)),
              "tw": np.zeros((s.clusters * GROUPS, h, PER_GROUP)),
              "tb": np.log(tail_p / group_p[:, :, None]).reshape(-1, PER_GROUP)}
    return {k: v.astype(np.float32) for k, v in p.items()}


def flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([x.ravel() for x in p.values()])


def unflat(v: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in like:
        out[k] = v[at:at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def _columns(rows: int, n: int) -> np.ndarray:
    """Rows of ``n`` columns, not a multiple of a memory page apart: such rows drive each other out of the cache."""
    return np.empty((rows, n + (272 - n) % 1024), np.float32)[:, :n]


def _softmax(w: np.ndarray, bias: np.ndarray, cuts: list[int], outs: np.ndarray, target: np.ndarray,
             logp: np.ndarray, d: np.ndarray | None = None):
    """Adds to ``logp`` the log-probability of each row's target by the weights
    ``w[i]`` of its part, which are rows ``cuts[i]:cuts[i + 1]``; with ``d`` adds to
    it the gradient of the negative by the states and returns those by weights and
    biases. States are between -1 and 1, the last column is ones."""
    both = np.concatenate([w, (bias - bias.max(1, keepdims=True))[:, None]], axis=1)
    steep, grad, back = np.abs(w).sum(1).max() > STEEP, np.zeros_like(both), w.transpose(0, 2, 1).copy()
    width, part, ones = w.shape[2], 0, np.ones(w.shape[2], np.float32)
    for lo in range(0, cuts[-1], BLOCK):
        hi = min(lo + BLOCK, cuts[-1])
        while cuts[part + 1] <= lo:
            part += 1
        parts, i = [], part
        while i < len(w) and cuts[i] < hi:
            if cuts[i] < cuts[i + 1]:
                parts.append((i, slice(max(lo, cuts[i]) - lo, min(hi, cuts[i + 1]) - lo)))
            i += 1
        o, e = outs[lo:hi], np.empty((hi - lo, width), np.float32)
        for i, rows in parts:
            np.matmul(o[rows], both[i], out=e[rows])
        if steep:
            e -= e.max(1, keepdims=True)
        at = np.arange(0, e.size, width) + target[lo:hi]
        own = e.ravel()[at]
        np.exp(e, out=e)
        total = e @ ones
        logp[lo:hi] += own - np.log(total)
        if d is not None:
            e /= total[:, None]
            e.ravel()[at] -= 1
            for i, rows in parts:
                grad[i] += o[rows].T @ e[rows]
                d[lo:hi][rows] += e[rows] @ back[i]
    return grad[:, :-1], grad[:, -1]


def _steps(size: np.ndarray, width: int, lanes: int, tokens: int):
    """Windows of sequences of these sizes: ``(sequences of the lanes, lanes at
    each step, lane and step of each target)``."""
    order = np.argsort(-size, kind="stable")
    for g in range(0, len(order), lanes):
        group = order[g:g + lanes]
        own = size[group]
        t = 0
        while t < own[0]:
            n = int((own > t).sum())
            steps = np.arange(t, min(t + max(width, -(-tokens // n)), int(own[0])))
            at = np.searchsorted(-own, -steps)
            ends = np.cumsum(at)
            yield group, at, np.arange(ends[-1]) - np.repeat(ends - at, at), np.repeat(steps, at)
            t += len(steps)


def windows(docs: list[np.ndarray], start: int, width: int = WINDOW,
            lanes: int = LANES, tokens: int = 0) -> Iterator[tuple[np.ndarray, list[int], np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of documents (id arrays, ends included) as windows: ``(documents
    of the lanes, lanes at each step, inputs, targets, first)``; steps are laid
    out one after the other, ``first`` marks a group's first window. Windows are
    ``width`` steps, more where their lanes have fewer than ``tokens``."""
    size = np.array([len(d) for d in docs])
    ids, begin = np.concatenate([[start], *docs]).astype(np.int32), np.cumsum(size) - size + 1
    for group, at, lane, step in _steps(size, width, lanes, tokens):
        y = begin[group[lane]] + step
        yield group, at.tolist(), ids[np.where(step > 0, y - 1, 0)], ids[y], step[0] == 0


def packed(docs: list[np.ndarray], start: int, lanes: int, tokens: int):
    """All documents as windows of at most ``lanes`` lanes, which hold several
    documents one after the other so that they are about as long: ``(lanes at each
    step, inputs, targets, first, where the targets lie in all documents' ids,
    numbers of the targets that begin a document)``; else as ``windows``."""
    if not docs:
        return
    size = np.array([len(d) for d in docs], np.int32)
    held = [(0, k, []) for k in range(min(lanes, len(docs)))]
    for i in np.argsort(-size, kind="stable").tolist():
        n, k, own = held[0]
        own.append(i)
        heapq.heapreplace(held, (n + len(docs[i]), k, own))
    ids, begin = np.concatenate([*docs, [start]]).astype(np.int32), np.cumsum(size, dtype=np.int32) - size
    order = np.array([i for _, _, own in held for i in own])
    # Targets in the order of lanes: where they lie, and where their inputs do.
    size, begin, head = size[order], begin[order], np.cumsum(size[order], dtype=np.int32) - size[order]
    place = np.arange(len(ids) - 1, dtype=np.int32) + np.repeat(begin - head, size)
    before = place - 1
    before[head[size > 0]] = len(ids) - 1
    lane_size = np.array([n for n, _, _ in held])
    lane_at = np.cumsum(lane_size) - lane_size
    for group, at, lane, step in _steps(lane_size, WINDOW, lanes, tokens):
        i = lane_at[group[lane]] + step
        x = before[i]
        yield at.tolist(), ids[x], ids[place[i]], step[0] == 0, place[i], np.flatnonzero(x == len(ids) - 1)


def _fresh(begins: np.ndarray, at: list[int]) -> dict[int, list[int]]:
    """Lanes where a document begins, of the steps that have such."""
    ends, out = np.cumsum(at), {}
    step = np.searchsorted(ends, begins, side="right")
    for i, lane in zip(step.tolist(), (begins - (ends - at)[step]).tolist(), strict=True):
        out.setdefault(i, []).append(lane)
    return out


class Runner:
    """One pass over windows with a fixed or learning model. ``inputs`` gives
    each id's input row, if that isn't the id."""

    def __init__(self, p: dict[str, np.ndarray], s: Sizes, inputs: np.ndarray | None = None):
        self.p, self.s, self.inputs = p, s, inputs
        self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
        self.steps, self.h = 0, np.zeros((s.hidden, 0), np.float32)

    def forward(self, at: list[int], x: np.ndarray, first: bool, keep: bool = True, begins: np.ndarray = NONE):
        """States of a window (a column per step and lane) and, with ``keep``,
        what ``backward`` needs; ``self.h`` goes in and comes out. Columns ``begins``
        begin a document, with a state of zeros."""
        p, k = self.p, self.s.hidden
        if first:
            self.h = np.zeros((k, at[0]), np.float32)
        outs, gates, kept, lo, base = _columns(k, len(x)), np.empty((3 * k, 0), np.float32), [], 0, 0
        # Gates that are sigmoids have the other sign until they are.
        h, u = self.h, p["u"].T * np.repeat(np.float32([-1, 1]), [2 * k, k])[:, None]
        fresh = _fresh(begins, at)
        for i, n in enumerate(at):
            if n < h.shape[1]:
                h = np.ascontiguousarray(h[:, :n])
            if i in fresh:
                h[:, fresh[i]] = 0
            if lo + n > base + gates.shape[1]:
                rows = np.take(p["x"], x[lo:lo + max(n, BLOCK)], axis=0)
                base, gates = lo, _columns(3 * k, len(rows))
                gates[:] = rows.T
            g, a = gates[:, lo - base:lo - base + n], u @ h
            zr, an = a[:2 * k], a[2 * k:]
            zr -= g[:2 * k]
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            c = zr[k:] * an
            c += g[2 * k:]
            np.tanh(c, out=c)
            new = h - c
            new *= zr[:k]
            new += c
            if keep:
                kept.append((h, a, c))
            outs[:, lo:lo + n] = new
            h, lo = new, lo + n
        self.h = h
        return outs, kept

    def output(self, outs: np.ndarray, target: np.ndarray, learn: bool):
        """Log-probabilities of the targets; with ``learn`` also gradients of
        the negative log-probability. Tokens are put in order of their classes
        and groups first, so that each of these is a slice."""
        p, s, k, n_classes = self.p, self.s, self.s.per_class, self.s.n_classes
        key = np.where(target < s.n_words, target // k, target - s.n_words + n_classes - 2)
        if s.tail:
            key = np.where(target > s.rare, n_classes + (target - s.rare - 1) // PER_GROUP, key)
        order = np.argsort(key.astype(np.uint16) if n_classes + s.clusters * GROUPS <= 1 << 16 else key, kind="stable")
        o = np.ones((len(order), s.hidden + 1), np.float32)
        o[:, :-1] = outs.T
        o, target, cls = o[order], target[order], key[order]
        tail = int(np.searchsorted(cls, n_classes))
        group = cls[tail:] - n_classes
        cls[tail:] = n_classes + group // GROUPS
        cuts = np.searchsorted(cls, np.arange(n_classes + s.clusters + 1)).tolist()
        logp, grad = np.zeros(len(order), np.float32), {}
        d = np.zeros((len(order), s.hidden), np.float32) if learn else None

        def add(w: str, b: str, cuts: list[int], at: int, place: np.ndarray) -> None:
            by = _softmax(p[w].reshape(-1, *p[w].shape[-2:]), p[b].reshape(-1, p[b].shape[-1]), cuts, o[at:], place,
                          logp[at:], d[at:] if learn else None)
            if learn:
                grad[w], grad[b] = (g.reshape(p[x].shape) for g, x in zip(by, (w, b), strict=True))

        add("cw", "cb", [0, len(order)], 0, cls)
        add("ww", "wb", cuts[:n_classes - 1], 0, target - cls * k)
        if s.tail:
            add("gw", "gb", [c - tail for c in cuts[n_classes:]], tail, group % GROUPS)
        if tail < len(target):
            self._grouped(o[tail:], group, (target[tail:] - s.rare - 1) % PER_GROUP, learn,
                          logp[tail:], grad, d[tail:] if learn else None)
        back = np.empty_like(logp)
        back[order] = logp
        if learn:
            d_out = np.empty_like(d)
            d_out[order] = d
            return back, grad, d_out.T.copy()
        return back, grad, None

    def _grouped(self, outs, group, word, learn: bool, logp, grad, d) -> None:
        """Adds what words of a group say of the tail's tokens, which are in
        order of their groups. Biases are weights of one more state that is one."""
        p, h, n = self.p, self.s.hidden, len(group)
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        sizes = np.diff(np.r_[first, n])
        # Smallest groups first; those of one size are one product, those of many tokens one each.
        by = np.argsort(sizes, kind="stable")
        rows, sizes, first = group[first][by], sizes[by], first[by]
        ends = np.cumsum(sizes)
        tokens = np.arange(n) + np.repeat(first - (ends - sizes), sizes)
        same = np.flatnonzero(np.r_[True, (sizes[1:] != sizes[:-1]) | (sizes[1:] > MANY), True])
        o, word = outs[tokens], word[tokens]
        w = np.concatenate([p["tw"][rows], p["tb"][rows][:, None]], axis=1)
        e = np.empty((n, PER_GROUP), np.float32)
        alike = [(slice(i, j), slice(int(ends[i] - sizes[i]), int(ends[j - 1])), (j - i, int(sizes[i]), -1))
                 for i, j in zip(same[:-1].tolist(), same[1:].tolist())]
        for some, cols, shape in alike:
            np.matmul(o[cols].reshape(shape), w[some], out=e[cols].reshape(shape))
        e -= e.max(1, keepdims=True)
        place = np.arange(n) * PER_GROUP + word
        own = e.ravel()[place]
        np.exp(e, out=e)
        total = e.sum(1)
        logp[tokens] += own - np.log(total)
        if learn:
            e /= total[:, None]
            e.ravel()[place] -= 1
            each, back = np.empty_like(w), np.empty((n, h), np.float32)
            for some, cols, shape in alike:
                g = e[cols].reshape(shape)
                np.matmul(o[cols].reshape(shape).transpose(0, 2, 1), g, out=each[some])
                np.matmul(g, w[some, :h].transpose(0, 2, 1), out=back[cols].reshape(shape))
            d[tokens] += back
            grad["tw"], grad["tb"] = (rows, each[:, :h]), (rows, each[:, h])

    def backward(self, at: list[int], x: np.ndarray, kept: list, d_out: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of input rows and recurrence through the window."""
        (rows, own), u = self._backward(at, x, kept, d_out)
        gx = np.zeros_like(self.p["x"])
        gx[rows] = own
        return {"x": gx, "u": u}

    def _backward(self, at: list[int], x: np.ndarray, kept: list, d_out: np.ndarray):
        """Numbers and gradients of the input rows met, gradient of the recurrence."""
        k, u = self.s.hidden, self.p["u"]
        prev, acts, c = (np.concatenate(arrays, axis=1, out=_columns(len(arrays[0]), len(x)))
                         for arrays in zip(*kept, strict=True))
        z, r, an = acts[:k], acts[k:2 * k], acts[2 * k:]
        # Gradients of the gates are these times the state's, which goes back from step to step.
        d_rec = _columns(3 * k, len(x))
        by = d_rec.base.reshape(3, k, -1)[:, :, :len(x)]
        by_c = 1 - c * c
        by_c *= 1 - z
        np.multiply(by_c, r, out=by[2])
        np.subtract(1, r, out=by[1])
        by[1] *= an
        by[1] *= by[2]
        np.subtract(1, z, out=by[0])
        by[0] *= z
        by[0] *= prev - c
        hi, dh = len(x), np.zeros((k, 0), np.float32)
        for n in reversed(at):
            lo = hi - n
            d = d_out[:, lo:hi]
            d[:, :dh.shape[1]] += dh
            step = by[:, :, lo:hi]
            step *= d
            dh = u @ d_rec[:, lo:hi]
            dh += d * z[:, lo:hi]
            hi = lo
        by_c *= d_out
        d_u = (d_rec @ prev.T).T
        d_gate = d_rec
        d_gate[2 * k:] = by_c
        order = np.argsort(x.astype(np.uint16) if self.s.n_in <= 1 << 16 else x, kind="stable")
        xs = x[order]
        first = np.flatnonzero(np.r_[True, xs[1:] != xs[:-1]])
        return (xs[first], np.add.reduceat(np.take(d_gate, order, axis=1), first, axis=1).T), d_u

    def learn(self, at, x, target, first, rate: float) -> None:
        """One Adam step on a window; of input rows and groups, on those met."""
        outs, kept = self.forward(at, x, first)
        _, grad, d_out = self.output(outs, target, True)
        grad["x"], grad["u"] = self._backward(at, x, kept, d_out)
        self.steps += 1
        fix = np.sqrt(1 - 0.99 ** self.steps) / (1 - 0.9 ** self.steps)
        for k, g in grad.items():
            rows, g = g if isinstance(g, tuple) else (None, g)
            if rows is None:
                _adam(self.p[k], *self.moments[k], g, len(x), rate * fix)
                continue
            # Some rows at a time, which then stay in the cache.
            some = max(1, BLOCK * PER_GROUP // g[0].size)
            for lo in range(0, len(rows), some):
                i = rows[lo:lo + some]
                own = self.p[k][i], *(a[i] for a in self.moments[k])
                _adam(*own, g[lo:lo + some], len(x), rate * fix)
                self.p[k][i], self.moments[k][0][i], self.moments[k][1][i] = own


def _adam(p, m, v, g, n: int, rate: float) -> None:
    """One step on weights and moments in place, for a gradient that sums over ``n`` tokens."""
    g = g * np.float32(1 / n)
    m *= np.float32(0.9)
    m += np.float32(0.1) * g
    g *= g
    g *= np.float32(0.01)
    v *= np.float32(0.99)
    v += g
    np.sqrt(v, out=g)
    g += np.float32(1e-6)
    np.divide(m, g, out=g)
    g *= np.float32(rate)
    p -= g


def train(runner: Runner, docs: list[np.ndarray], rate: float) -> None:
    """Learns from the documents."""
    s = runner.s
    for _, at, x, y, first in windows(docs, s.end, tokens=LEARNED):
        runner.learn(at, x if runner.inputs is None else runner.inputs[x], s.targets(y), first, rate)


def log_likelihood(runner: Runner, docs: list[np.ndarray]) -> np.ndarray:
    """Natural-log probability of each document's ids."""
    size, s = [len(d) for d in docs], runner.s
    each = np.zeros(sum(size), np.float32)
    for at, x, y, first, place, begins in packed(docs, s.end, LANES, SCORED):
        outs, _ = runner.forward(at, x if runner.inputs is None else runner.inputs[x], first, False, begins)
        each[place] = runner.output(outs, s.targets(y), False)[0]
    return np.bincount(np.repeat(np.arange(len(docs)), size), each, len(docs))

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from keysieve.llm import gru
from keysieve.llm import lm_score as L


def brute_base(rows):
    words = [((t or "").encode().lower().split()) for _, t in rows]
    held = [d is None or zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows]
    c, end = Counter(), 0
    for w, h in zip(words, held):
        if not h:
            c.update(w)
            end += 1
    n, v = sum(c.values()) + end, len(c) + (end > 0)
    lp = lambda k: math.log10((k + 1) / (n + v + 1))
    return sorted(((d, h, len(w) + 1, sum(x in c for x in w) + (end > 0), n, sum(lp(c[x]) for x in w) + lp(end))
                   for (d, _), w, h in zip(rows, words, held)), key=str)


def check(df, rows):
    got = sorted((tuple(r) for r in L.lm_scores(df).collect()), key=str)
    want = brute_base(rows)
    assert [x[:5] for x in got] == [x[:5] for x in want]
    for x, y in zip(got, want):
        assert x[5] == pytest.approx(y[5], rel=1e-9, abs=1e-6) and x[6] <= 1e-9 and math.isfinite(x[6])
    return got


def test_odd_rows(documents, odd_rows):
    check(documents(odd_rows), odd_rows)


@pytest.mark.parametrize("head", [3, 40])
def test_counts_beyond_the_head_are_joined(documents, odd_rows, head, monkeypatch):
    monkeypatch.setattr(L, "HEAD", head)
    check(documents(odd_rows), odd_rows)


def test_nothing_to_learn_from(documents):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    check(documents([(held, "a b")]), [(held, "a b")])
    assert L.lm_scores(documents([])).isEmpty()


def test_beats_the_base_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    r = L.lm_scores(docs).where("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert r["s"] > 0.97 * r["b"]


def model(rows=60, hidden=5, seed=0):
    rng = np.random.default_rng(seed)
    s = gru.Sizes(4 * 3 + 1 + 5, 6, 3, hidden)
    p = gru.initial(s, np.full(6, 1 / 6), np.full((4, 3), 1 / 3))
    p = {k: (v + rng.normal(0, 0.3, v.shape)).astype(v.dtype) for k, v in p.items()}
    docs = [rng.integers(0, s.n_in, rng.integers(1, rows)).astype(np.int32) for _ in range(9)]
    return s, p, docs


def test_next_token_probabilities_sum_to_one():
    s, p, docs = model()
    ends = [np.r_[docs[0], t].astype(np.int32) for t in range(s.rare + 1)]
    base = gru.log_likelihood(gru.Runner(p, s), [docs[0]])[0]
    each = np.exp([gru.log_likelihood(gru.Runner(p, s), [d])[0] - base for d in ends])
    assert each.sum() == pytest.approx(1, abs=1e-4)


def test_state_is_carried_across_windows_and_lanes_do_not_mix():
    s, p, docs = model()
    together = gru.log_likelihood(gru.Runner(p, s), docs)
    for d, got in zip(docs, together):
        h, x, want = np.zeros(s.hidden), s.end, 0.0
        sig = lambda v: 1 / (1 + np.exp(-v))
        for y in d.tolist():
            a, g, n = h @ p["u"], p["x"][x], s.hidden
            z, r = sig(a[:n] + g[:n]), sig(a[n:2 * n] + g[n:2 * n])
            h = (1 - z) * np.tanh(g[2 * n:] + r * a[2 * n:]) + z * h
            t = min(y, s.rare)
            e = np.exp(h @ p["cw"] + p["cb"])
            c = t // s.per_class if t < s.n_words else t - s.n_words + s.n_classes - 2
            want += math.log(e[c] / e.sum())
            if t < s.n_words:
                e = np.exp(h @ p["ww"][c] + p["wb"][c])
                want += math.log(e[t % s.per_class] / e.sum())
            x = y
        assert got == pytest.approx(want, rel=1e-3, abs=1e-3)


def test_gradients():
    s, p, docs = model(rows=12)
    _, at, x, y, first = next(gru.windows(docs, s.end))
    y = np.minimum(y, s.rare)

    def loss(q):
        r = gru.Runner(q, s)
        return -r.output(r.forward(at, x, first)[0], y, False)[0].astype(np.float64).sum()

    r = gru.Runner(p, s)
    outs, kept = r.forward(at, x, first)
    _, grad, d = r.output(outs, y, True)
    grad |= r.backward(at, x, kept, d)
    rng = np.random.default_rng(1)
    for k in gru.NAMES:
        for _ in range(4):
            i = tuple(rng.integers(0, n) for n in p[k].shape)
            up, down = ({a: b.copy() for a, b in p.items()} for _ in range(2))
            up[k][i] += 0.02
            down[k][i] -= 0.02
            assert grad[k][i] == pytest.approx((loss(up) - loss(down)) / 0.04, rel=0.05, abs=0.02)


def tail_model(hidden=5, tail=gru.GROUPS * gru.PER_GROUP + 700):
    rng = np.random.default_rng(3)
    s = gru.Sizes(4 * 3 + 1 + 5, 6, 3, hidden, tail, 18)
    tail_p = np.full((s.clusters, gru.GROUPS, gru.PER_GROUP), 1e-12)
    tail_p.ravel()[:tail] = 1 / tail
    p = gru.initial(s, np.full(6 + s.clusters, 1 / (6 + s.clusters)), np.full((4, 3), 1 / 3), tail_p=tail_p)
    inputs = np.r_[np.arange(18), np.full(tail, s.rare + 2)].astype(np.int32)
    docs = [rng.integers(0, 18 + tail, 40).astype(np.int32) for _ in range(9)]
    return s, p, inputs, docs


def test_words_beyond_the_classes_have_probabilities_of_their_own():
    s, p, inputs, docs = tail_model()
    rng = np.random.default_rng(4)
    p = {k: (v + rng.normal(0, 0.3, v.shape)).astype(v.dtype) if k != "tb" else v for k, v in p.items()}
    r = gru.Runner(p, s, inputs)
    base = gru.log_likelihood(r, [docs[0]])[0]
    each = [*range(s.rare + 1), *range(s.tail_at, s.tail_at + s.tail)]
    got = np.exp(gru.log_likelihood(r, [np.r_[docs[0], t].astype(np.int32) for t in each]) - base)
    # What is missing are the empty groups of the last cluster.
    assert 0.8 < got.sum() <= 1 + 1e-3 and len(set(got[s.rare + 1:].tolist())) > s.tail / gru.PER_GROUP / 2


def test_gradients_of_the_tail():
    s, p, inputs, docs = tail_model()
    rng = np.random.default_rng(5)
    p = {k: (v + rng.normal(0, 0.3, v.shape)).astype(v.dtype) for k, v in p.items()}
    _, at, x, y, first = next(gru.windows(docs, s.end))
    x, y = inputs[x], s.targets(y)

    def loss(q):
        r = gru.Runner(q, s)
        return -r.output(r.forward(at, x, first)[0], y, False)[0].astype(np.float64).sum()

    r = gru.Runner(p, s)
    outs, kept = r.forward(at, x, first)
    _, grad, d = r.output(outs, y, True)
    grad |= r.backward(at, x, kept, d)
    for k in p:
        rows, g = grad[k] if isinstance(grad[k], tuple) else (None, grad[k])
        for _ in range(4):
            i = tuple(rng.integers(0, n) for n in g.shape)
            at_p = i if rows is None else (rows[i[0]], *i[1:])
            up, down = ({a: b.copy() for a, b in p.items()} for _ in range(2))
            up[k][at_p] += 0.02
            down[k][at_p] -= 0.02
            assert g[i] == pytest.approx((loss(up) - loss(down)) / 0.04, rel=0.05, abs=0.03)


def test_context_tells_words_beyond_the_classes():
    """Texts of two halves of the tail: the model learns which half a text is of."""
    head = [(f"c{i:04d}".encode(), 900) for i in range(960)] + [(f"w{i:04d}".encode(), 90) for i in range(800)]
    v = L.Vocabulary(head, 400, len(head), sum(c for _, c in head))
    assert v.sizes.n_words + v.sizes.tail == len(head)
    rng = np.random.default_rng(6)
    texts = [" ".join(f"w{k:04d}" for k in rng.integers(0, 400, 100) + 400 * (i % 2)) for i in range(400)]
    w = L.Words(texts)
    docs = v.ids(v.places(w), w)
    assert (np.concatenate([d[:-1] for d in docs]) >= v.sizes.tail_at).all()
    r = gru.Runner(v.initial(), v.sizes, v.inputs)
    for _ in range(40):
        gru.train(r, docs[50:], 0.01)
    # Better than any distribution that does not see the words before.
    assert gru.log_likelihood(r, docs[:50]).sum() > -50 * 100 * math.log(800) + 1000


def test_a_long_document_is_learned_in_few_steps():
    s, p, _ = model()
    docs = [np.arange(n, dtype=np.int32) % s.n_in for n in (3 * gru.LEARNED, 40, 40)]
    r = gru.Runner(p, s)
    gru.train(r, docs, 0.01)
    assert r.steps <= 4  # of 32 tokens of its own it would be hundreds


def test_windows_hold_every_token_once_and_in_order():
    s, _, _ = model()
    rng = np.random.default_rng(8)
    docs = [rng.integers(0, s.n_in, n).astype(np.int32) for n in (700, 90, 33, 32, 31, 1, 1)]
    for tokens in (0, 64, 500, 10 ** 6):
        seen, before = [[] for _ in docs], [[] for _ in docs]
        for group, at, x, y, _ in gru.windows(docs, s.end, lanes=4, tokens=tokens):
            lo = 0
            for n in at:
                for j, i in enumerate(group[:n].tolist()):
                    before[i].append(x[lo + j])
                    seen[i].append(y[lo + j])
                lo += n
            assert lo == len(x) == len(y)
        assert [list(d) for d in docs] == seen
        assert [[s.end, *d[:-1]] for d in docs] == before


@pytest.mark.parametrize("block, steep, many", [(5, 60, 12), (2048, 0, 12), (2048, 60, 0), (2048, 60, 10 ** 6)])
def test_blocks_and_group_sums_do_not_change_the_output(monkeypatch, block, steep, many):
    s, p, inputs, docs = tail_model()
    docs += [np.full(50, s.tail_at + 3, np.int32)]  # a group of many columns
    rng = np.random.default_rng(9)
    p = {k: (v + rng.normal(0, 0.3, v.shape)).astype(v.dtype) for k, v in p.items()}
    _, at, x, y, first = next(gru.windows(docs, s.end))

    def run():
        r = gru.Runner(p, s, inputs)
        logp, grad, d = r.output(r.forward(at, inputs[x], first)[0], s.targets(y), True)
        out = {"logp": logp, "d": d}
        for k, g in grad.items():
            out[k] = np.zeros_like(p[k])
            out[k][g[0] if isinstance(g, tuple) else slice(None)] = g[1] if isinstance(g, tuple) else g
        return out

    want = run()
    monkeypatch.setattr(gru, "BLOCK", block)
    monkeypatch.setattr(gru, "STEEP", steep)
    monkeypatch.setattr(gru, "MANY", many)
    for k, g in run().items():
        np.testing.assert_allclose(g, want[k], rtol=1e-3, atol=1e-4)


def test_packed_lanes_hold_every_token_once_and_are_about_as_long():
    s, _, _ = model()
    rng = np.random.default_rng(10)
    docs = [rng.integers(0, s.rare, n).astype(np.int32) for n in (300, 90, 80, 70, 33, 32, 1, 1, 50, 60)]
    flat, steps = np.concatenate(docs), 0
    begin = np.cumsum([0, *map(len, docs)])[:-1]
    seen = np.zeros(len(flat), int)
    for at, x, y, _, place, begins in gru.packed(docs, s.end, lanes=3, tokens=64):
        steps += len(at)
        seen[place] += 1
        assert (y == flat[place]).all() and sum(at) == len(x)
        assert set(place[begins]) == set(place) & set(begin)
        want = np.where(np.isin(place, begin), s.end, flat[place - 1])
        assert (x == want).all()
    assert (seen == 1).all() and steps == 300  # in groups of three it would be 450


@pytest.mark.parametrize("lanes", [1, 2, 4])
def test_documents_of_one_lane_do_not_mix(monkeypatch, lanes):
    s, p, docs = model()
    alone = [gru.log_likelihood(gru.Runner(p, s), [d])[0] for d in docs]
    monkeypatch.setattr(gru, "LANES", lanes)
    monkeypatch.setattr(gru, "SCORED", 40)
    assert gru.log_likelihood(gru.Runner(p, s), docs) == pytest.approx(alone, rel=1e-4)
    assert len(gru.log_likelihood(gru.Runner(p, s), [])) == 0


def test_kinds_of_short_words():
    w = L.Words(["a\tab abc\x0bé\x85x", "zabc"])
    raw = [b.encode() for b in ("a", "ab", "abc", "é\x85x", "zabc")]
    assert w.words.to_pylist() == raw
    want = [((r[-1] * 31 + (r[-2] if len(r) > 1 else 0)) * 31 + (r[-3] if len(r) > 2 else 0)) % L.KINDS for r in raw]
    assert w.kinds().tolist() == want and w.kinds(np.array([False, True, False, False, True])).tolist() == [want[1], want[4]]

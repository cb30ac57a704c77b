import hashlib

import numpy as np
import pytest

from keysieve.llm import vector_codes as V


def brute(rows, parts=16, entries=64, rounds=2):
    """Plain search over all entries, in Python integers."""
    kept = [(i, lab, [int(np.floor(256.0 * x)) for x in v]) for i, v, lab in rows
            if v and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    dim = len(kept[0][2])
    width = dim // parts
    cut = lambda v: [tuple(v[p * width:(p + 1) * width]) for p in range(parts)]
    books = [[cut(v)[p] for _, _, v in kept[:entries]] for p in range(parts)]

    def nearest(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(e, x)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        new = []
        for p, book in enumerate(books):
            owned = [[] for _ in book]
            for _, _, v in kept:
                owned[nearest(book, cut(v)[p])[1]].append(cut(v)[p])
            new.append([tuple(sum(c) // len(xs) for c in zip(*xs)) if xs else e for e, xs in zip(book, owned)])
        books = new
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, label = [], {}
    for i, lab, v in kept:
        found = [nearest(b, x) for b, x in zip(books, cut(v))]
        out.append((i, lab, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
        label[lab] = label.get(lab, 0) + out[-1][3]
    return sorted(((i, c, e, label[lab], digest) for i, lab, c, e in out), key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr(
        "*", "'x' as v", "1 as code", "2 as error", "3 as p", "4 as label_error")


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def vectors(n, dim=32, seed=0, grid=None):
    r = np.random.default_rng(seed)
    x = r.normal(0, 0.2, (n, dim)).astype(np.float32)
    if grid:
        x = np.round(x * grid) / grid  # many ties and repeated entries
    return [(int(i), [float(c) for c in v], int(i) % 3 if i % 5 else None) for i, v in enumerate(x)]


@pytest.mark.parametrize("n, grid", [(300, None), (300, 2), (20, None), (1, None)])
def test_as_a_plain_search(spark, n, grid):
    rows = vectors(n, seed=n, grid=grid)
    assert got(V.vector_codes(frame(spark, rows))) == brute(rows)


def test_odd_rows(spark):
    rows = vectors(120, seed=7)
    dim = len(rows[0][1])
    rows += [(200, None, 1), (201, [None] * dim, 1), (202, [0.1] * (dim - 1) + [float("nan")], 1), (203, [], 1),
             (204, [float("inf")] * dim, 1), (205, [0.0] * dim, None), (None, [0.5] * dim, 2), (3, rows[4][1], 0),
             (3, rows[3][1], 0), (3, rows[3][1], 0)]
    assert got(V.vector_codes(frame(spark, rows))) == brute(rows)
    ragged = rows + [(300, [0.5] * 16, 1), (301, [0.5] * 7, 1)]
    assert got(V.vector_codes(frame(spark, ragged))) == brute(rows)


def test_empty_table(spark):
    for rows in ([], [(1, None, 1)]):
        out = V.vector_codes(frame(spark, rows))
        assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and out.isEmpty()


def test_large_components(spark):
    rows = [(k, [1000.0 * k] * 16, 0) for k in range(70)]
    assert got(V.vector_codes(frame(spark, rows))) == brute(rows)
    with pytest.raises(Exception, match="after scaling"):
        V.vector_codes(frame(spark, [(1, [1e30] * 16, 0)])).collect()


def test_files_do_not_matter(spark):
    rows = vectors(200, seed=5)
    assert got(V.vector_codes(frame(spark, rows).repartition(11))) == got(V.vector_codes(frame(spark, rows[::-1]).coalesce(1)))


@pytest.mark.parametrize("seed", range(8))
def test_gnat_finds_the_nearest_and_skips_subtrees(seed):
    r = np.random.default_rng(seed)
    width = int(r.integers(1, 6))
    entries = r.integers(-60, 60, (64, width)) if seed % 2 else r.integers(-3, 4, (64, width))
    entries = np.concatenate([entries, entries[:5]])
    points = np.concatenate([r.integers(-70, 70, (500, width)), entries])
    d = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    tree = V.Gnat(entries)
    index, best = tree.nearest(points)
    assert (index == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    if width < 4:
        assert tree.computed < 0.8 * d.size


def test_codes_decode_within_their_error(spark):
    rows = vectors(100, seed=9)
    kept, dim = V.scaled(frame(spark, rows))
    books = V.train(kept, dim)
    original = {r["vec_id"]: np.array(r["v"]) for r in kept.collect()}
    for r in V.coded(kept, dim, books).collect():
        assert ((V.decode(r["code"], books) - original[r["vec_id"]]) ** 2).sum() == r["error"]

import math
import random

import numpy as np

from tenura.llm import pivots
from tenura.llm.pivots import top_k

VECTORS = "vec_id long, embedding array<double>, label int, rank int, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x") for i, v in rows], VECTORS)


def plain(rows, k=5, every=50):
    """The same by whole numbers, every query against every row."""
    good = {(i, tuple(math.floor(256 * x) if abs(x) < 1e300 else int(256 * x) for x in v)) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, a in good:
        if q % every == 0:
            scored = sorted((-max(-2**63, min(2**63 - 1, sum(x * y for x, y in zip(a, b)))), i) for i, b in good
                            if i != q and len(a) == len(b))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def ours(spark, rows, **more):
    return sorted(map(tuple, top_k(frame(spark, rows), **more).collect()))


def test_like_brute_force_over_many_blocks(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(400)]
    assert ours(spark, rows) == plain(rows)
    assert ours(spark, rows, block_rows=64, query_rows=3, n_pivots=4) == plain(rows)


def test_ties_copies_and_hot_groups(spark):
    rows = [(i, [0.5, 0.25]) for i in range(150)] + [(i, [float(i % 3), 0.0]) for i in range(150, 260)]
    assert ours(spark, rows, block_rows=50) == plain(rows)


def test_bad_vectors_nulls_repeats_and_lengths(spark):
    inf, nan = math.inf, math.nan
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (50, None), (100, [1.0, None]), (150, [nan, 1.0]), (200, [inf, 1.0]), (1, [3.0, -1.0]),
            (1, [3.0, -1.0]), (None, [9.0, 9.0]), (2, [1.0, 2.0, 3.0]), (250, [1.0, 1.0, 1.0]), (3, []), (4, [0.0, 0.0]), (300, [0.0, 0.0]),
            (0, [2.0, 2.0])]
    assert ours(spark, rows) == plain(rows)
    assert ours(spark, []) == []
    assert ours(spark, [(0, [1.0])]) == []


def test_components_beyond_the_range_of_doubles(spark):
    rows = [(0, [1e12, 3.0]), (1, [1e3, 1e12]), (2, [-1e15, 7.0]), (50, [1e200, 1.0]), (3, [0.1, 0.1])]
    assert ours(spark, rows) == plain(rows)


def test_bounds_spare_most_evaluations():
    rng = np.random.RandomState(3)
    centres = rng.normal(size=(20, 8)) * 400
    x = np.floor(centres[rng.randint(0, 20, 4000)] + rng.normal(size=(4000, 8)) * 4)
    x[:, :] *= 400 / np.sqrt((x * x).sum(axis=1, keepdims=True))
    x = np.floor(x)
    p = pivots.choose_pivots(x, 32)
    far = np.sqrt(((x[:, None, :] - p[None]) ** 2).sum(axis=2))
    ids, scores, seen = pivots.top_of_block(x[0], far[0], x, far, np.arange(4000), 0, 5)
    order = np.lexsort((np.arange(4000), -(x @ x[0])))
    want = [k for k in order if k != 0][:5]
    assert ids.tolist() == want and seen < 2000


def test_a_large_component_spares_the_other_rows(monkeypatch):
    rng = np.random.RandomState(4)
    centres = rng.normal(size=(20, 8)) * 400
    x = np.floor(centres[rng.randint(0, 20, 3000)] + rng.normal(size=(3000, 8)) * 4)
    x = np.floor(x * 400 / np.sqrt((x * x).sum(axis=1, keepdims=True)))
    x[7] = 2.0 ** 52                                                # one vector beyond doubles, and a pivot
    x[11, 0] = -2.0 ** 60
    p = np.r_[pivots.choose_pivots(x, 30), x[[7, 11]]]
    far = np.sqrt(((x[:, None, :] - p[None]) ** 2).sum(axis=2))
    ids, whole, counted = np.arange(3000), [[int(c) for c in row] for row in x], []
    real = pivots._whole
    monkeypatch.setattr(pivots, "_whole", lambda q, part: counted.append(len(part)) or real(q, part))
    for at in (0, 1, 7, 11, 500):
        counted.clear()
        got, scores, seen = pivots.top_of_block(x[at], far[at], x, far, ids, at, 5)
        exact = sorted((-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(whole[at], row)))), k) for k, row in enumerate(whole) if k != at)
        assert list(zip((-scores.astype(object)).tolist(), got.tolist())) == exact[:5]
        assert sum(counted) < 3000 and (at in (7, 11) or sum(counted) <= 2)


def test_a_far_pivot_does_not_hide_neighbours():
    rng = np.random.RandomState(5)
    x = np.floor(rng.normal(size=(600, 8)) * 300)
    p = np.full((1, 8), 2.0 ** 68)
    far = np.sqrt(((x[:, None, :] - p[None]) ** 2).sum(axis=2))
    far[::3] = np.nextafter(far[::3], np.inf)                        # what rounding may do
    want = [k for k in np.lexsort((np.arange(600), -(x @ x[1]))) if k != 1][:5]
    assert pivots.top_of_block(x[1], far[1], x, far, np.arange(600), 1, 5, step=8)[0].tolist() == want

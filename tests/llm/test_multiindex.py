import math
from collections import defaultdict

import numpy as np

from tenura.llm import multiindex
from tenura.llm.multiindex import near_vectors

VECTORS = "vec_id long, embedding array<float>, label int, node string, cell int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], VECTORS)


def plain(rows, threshold=0.9):
    """All pairs by cosine in double precision."""
    ok = [v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v) and any(v) for _, v in rows]
    unit = [np.float32(v).astype(float) / np.linalg.norm(np.float32(v).astype(float)) if g else None for (_, v), g in zip(rows, ok)]
    near = defaultdict(set)
    for a in range(len(rows)):
        for b in range(a):
            if ok[a] and ok[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                near[a].add(b)
                near[b].add(a)
    out, seen = [], {}
    for a in range(len(rows)):
        if a not in seen:
            group, todo = {a}, [a]
            while todo:
                for b in near[todo.pop()] - group:
                    group.add(b)
                    todo.append(b)
            ids = [rows[x][0] for x in group if rows[x][0] is not None]
            for x in group:
                seen[x] = min(ids) if ids else None
        out.append((rows[a][0], len(near[a]), seen[a], rows[a][0] == seen[a]))
    return sorted(out, key=repr)


def ours(spark, rows, **more):
    return sorted([(r.vec_id, r.n_links, r.component_id, r.kept) for r in near_vectors(frame(spark, rows), **more).collect()], key=repr)


def clustered(n, dim=8, groups=12, spread=0.1, seed=1):
    rng = np.random.RandomState(seed)
    c = rng.normal(size=(groups, dim))
    x = c[rng.randint(0, groups, n)] + rng.normal(size=(n, dim)) * spread * np.sqrt((c * c).sum(axis=1)).mean()
    return [(i, [float(v) for v in row.astype(np.float32)]) for i, row in enumerate(x)]


def test_every_cell_visited_is_brute_force(spark):
    rows = clustered(300)
    assert ours(spark, rows, recall=1.0, cell_rows=10, block_rows=20, probe_rows=15) == plain(rows)


def test_recall_of_links_is_at_least_the_target(spark):
    rows = clustered(800, dim=16, groups=60, spread=0.075)
    want = sum(r[1] for r in plain(rows))
    got = sum(r[1] for r in ours(spark, rows, cell_rows=20))
    assert want > 1000 and 0.9 * want <= got <= want


def test_large_group_over_many_blocks(spark):
    rows = [(i, [1.0, 0.001 * i, 0.0, 0.0]) for i in range(200)] + [(i, [0.0, 0.0, 1.0, float(i)]) for i in range(200, 210)]
    assert ours(spark, rows, block_rows=16, probe_rows=16, cell_rows=50) == plain(rows)


def test_copies_nulls_zero_and_odd_vectors(spark):
    rows = [(5, [1.0, 0.0]), (3, [1.0, 0.0]), (5, [1.0, 0.0]), (None, [1.0, 0.0]), (7, [2.0, 0.1]), (8, None), (9, []), (10, [0.0, 0.0]),
            (11, [math.nan, 1.0]), (12, [math.inf, 1.0]), (13, [1.0, None]), (14, [1.0, 0.0, 0.0]), (15, [-1.0, 0.0]), (16, [1e-30, 0.0]),
            (17, [3e38, 3e38]), (None, None)]
    assert ours(spark, rows) == plain(rows)
    assert ours(spark, []) == []
    assert ours(spark, [(1, None)]) == [(1, 0, 1, True)]
    assert ours(spark, [(1, [2.0])]) == [(1, 0, 1, True)]


def test_multi_sequence_is_sorted_by_sum():
    rng = np.random.RandomState(4)
    for _ in range(50):
        a, b = rng.rand(7), rng.rand(5)
        cells = multiindex.multi_sequence(a, b, 35)
        sums = [a[i] + b[j] for i, j in cells]
        assert len(set(cells)) == 35 and sums == sorted(sums)
        assert multiindex.multi_sequence(a, b, 6) == cells[:6]

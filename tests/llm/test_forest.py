import random
from collections import defaultdict

import numpy as np
import pytest

from tenura.llm import forest
from tenura.llm.forest import Forest, jaccard_join, keep_one


def plain(rows, size=5, threshold=0.8):
    docs = sorted(set((d, t or "") for d, t in rows), key=repr)
    sets = []
    for _, t in docs:
        w = t.lower().split()
        sets.append({tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    near = defaultdict(set)
    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9:
                near[a].add(b)
                near[b].add(a)
    out, seen = [], {}
    order = lambda x: (docs[x][0] is not None, docs[x][0] or 0)
    for a in range(len(docs)):
        if a not in seen:
            group, todo = {a}, [a]
            while todo:
                for b in near[todo.pop()] - group:
                    group.add(b)
                    todo.append(b)
            for x in group:
                seen[x] = docs[min(group, key=order)][0]
        same = sum(sets[a] == sets[b] for b in near[a])
        out.append((docs[a][0], len(sets[a]), same + 1, len(near[a]), seen[a]))
    return sorted(out, key=repr)


def ours(df, **more):
    return sorted([(r.doc_id, r.n_shingles, r.n_copies, r.n_links, r.class_id) for r in jaccard_join(df, **more).collect()], key=repr)


def words(rng, n):
    return [f"w{rng.randint(0, 5000)}" for _ in range(n)]


def edited(rng, base, k):
    out = list(base)
    for _ in range(k):
        out[rng.randrange(len(out))] = f"e{rng.randint(0, 9999)}"
    return out


def corpus(seed=1):
    rng = random.Random(seed)
    rows, n = [], 0
    for _ in range(25):
        base = words(rng, rng.randint(60, 200))
        for _ in range(rng.randint(1, 6)):
            rows.append((n, " ".join(edited(rng, base, rng.randint(0, 5)))))
            n += 1
        rows.append((n, " ".join(base)))
        n += 1
    return rows


def test_like_brute_force(docs_of):
    rows = corpus()
    want = plain(rows)
    assert sum(r[3] for r in want) > 50
    assert ours(docs_of(rows)) == want
    assert ours(docs_of(rows), cell_rows=2) == want


def test_large_groups_of_copies_and_near_copies(docs_of):
    rng = random.Random(2)
    base, other = words(rng, 120), words(rng, 80)
    rows = [(i, " ".join(base)) for i in range(60)] + [(i, " ".join(edited(rng, other, rng.randint(1, 2)))) for i in range(60, 140)]
    assert ours(docs_of(rows), cell_rows=16) == plain(rows)


def test_nulls_empty_short_repeats_and_long_texts(docs_of):
    rng = random.Random(3)
    long = words(rng, 30_000)
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a b c d e f"), (4, "a b c d e f"), (5, "A  B c\nd e f"), (5, "A  B c\nd e f"), (5, "other words"),
            (6, "x"), (7, "x"), (8, "x y"), (9, " ".join(long)), (10, " ".join(edited(rng, long, 100))), (None, None)]
    assert ours(docs_of(rows, {"node": "q", "who": "q"})) == plain(rows)
    assert ours(docs_of([])) == []


def test_one_document_of_each_class_stays(docs_of):
    rows = [(3, "a b c d e f"), (2, "a b c d e f"), (2, "A b c d e f"), (9, "own text"), (10, None), (11, ""), (2, "a b c d e f")]
    out = keep_one(docs_of(rows, {"gone_d": "q", "t": "q", "row": "q"}))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "gone_d", "t", "row"]
    kept = sorted([(r.doc_id, r.text) for r in out.collect()], key=repr)
    same = [r for r in kept if r[0] == 2]
    assert len({r[1] for r in same}) == 1  # texts of one id are documents of their own; repeated rows are one
    assert [r for r in kept if r[0] != 2] == sorted([(9, "own text"), (10, None), (11, "")], key=repr)


def test_prefix_is_shortened_to_the_target():
    f = Forest()
    d = f.prefix()
    expected = lambda d: 1 - (1 - f.threshold ** d) ** f.trees
    assert 1 < d < f.depth and expected(d) >= f.recall > expected(d + 1)


def test_signatures_agree_as_often_as_sets():
    f = Forest()
    a, b = f.permutations()
    rng = np.random.RandomState(5)
    for share in (0.5, 0.8, 0.95):
        both = rng.randint(0, 1 << 62, 2000).astype(np.uint64)
        n = int(2000 * share)
        x, y = np.unique(both[:1000 + n // 2]), np.unique(both[1000 - n // 2:])
        j = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        agree = (forest.signature(forest.mixed(x), a, b) == forest.signature(forest.mixed(y), a, b)).mean()
        assert abs(agree - j) < 0.12


def boilerplate(seed=7, n=90, common=120):
    """Texts that share a long passage, too unlike one another to be linked, and near copies of some of them."""
    rng = random.Random(seed)
    shared = words(rng, common)
    rows = [(i, " ".join(shared + words(rng, 60))) for i in range(n)]
    rows += [(n + i, " ".join(edited(rng, rows[i][1].split(), 3))) for i in range(0, n, 3)]
    return rows


def matched(docs, f):
    bare = forest.sign(docs, f).where("node IS NOT NULL").select("node", "labels").dropDuplicates(["node"])
    return forest.match(bare, f).collect()


def test_every_set_reaches_the_target_recall(docs_of):
    for rows, crowd in ((corpus(), 2), (boilerplate(), 2), (boilerplate(), 20), (corpus(), 10**6)):
        f = Forest(crowd=crowd)
        got = matched(docs_of(rows), f)
        assert len(got) == len({r.node for r in got})
        assert all(f.missed(r.depths) <= f.spare() * (1 + 1e-6) for r in got)
    assert {tuple(r.depths) for r in got} == {tuple(f.ordinary())}


def test_ordinary_prefixes_are_no_longer_than_needed():
    f = Forest()
    depths = f.ordinary()
    assert f.missed(depths) <= 1 - f.recall
    last = max(k for k, d in enumerate(depths) if d == min(depths))
    assert f.missed([*depths[:last], depths[last] + 1, *depths[last + 1:]]) > 1 - f.recall


def test_prefixes_of_crowds_stay_longer(docs_of):
    f = Forest(crowd=6)
    rows = [*boilerplate(n=60, common=200), *[(1000 + r[0], r[1]) for r in corpus()]]
    got = matched(docs_of(rows), f)
    size = {}
    for r in got:
        for tree, label in enumerate(r.labels):
            for level in range(1, 9):
                key = (tree, level, (label % 2**64) >> (64 - 8 * level))
                size[key] = size.get(key, 0) + 1
    plain_depth, kept = f.prefix(), 0
    for r in got:
        if max(r.depths) > plain_depth:
            for tree, d in enumerate(r.depths):
                crowd = size[tree, d, (r.labels[tree] % 2**64) >> (64 - 8 * d)] > f.crowd
                kept += size[tree, plain_depth, (r.labels[tree] % 2**64) >> (64 - 8 * plain_depth)] > f.crowd and d > plain_depth
                assert d == f.depth or not crowd    # none was shortened into a crowd
    assert kept


def test_crowds_change_no_result(docs_of):
    for rows, crowd in ((boilerplate(common=200), 6), (corpus(4), 1)):
        want = plain(rows)
        assert sum(r[3] for r in want) > 20
        assert ours(docs_of(rows), forest=Forest(crowd=crowd), cell_rows=8) == want


@pytest.mark.parametrize("crowd", [2, 6, 40])
def test_crowds_of_every_level(spark, crowd):
    from collections import Counter

    from tenura.llm.forest import Crowds, Forest

    rng = np.random.default_rng(crowd)
    values = np.where(rng.random((150, 2, 5)) < 0.6, 200, rng.integers(0, 256, (150, 2, 5)))
    labels = [[int.from_bytes(bytes([*v.tolist(), 0, 0, 0]), "big", signed=True) for v in row] for row in values]
    bare = spark.createDataFrame([(bytes([k]), row) for k, row in enumerate(labels)], "node binary, labels array<long>")
    crowds = Crowds(bare, Forest(trees=2, depth=5, crowd=crowd))
    for level in range(1, 5):
        n = Counter((tree, int.from_bytes(bytes(v[:level].tolist()), "big")) for row in values for tree, v in enumerate(row))
        assert {(r.tree, r.prefix) for r in crowds.at(level).collect()} == {k for k, c in n.items() if c > crowd}
    assert crowds.first == (2 if crowd == 2 else 1)

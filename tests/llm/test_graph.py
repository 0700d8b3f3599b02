import random

from tenura.llm.graph import components


def plain(edges):
    label = {}
    for a, b in edges:
        label.setdefault(a, a)
        label.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def ours(spark, edges, kind="long"):
    rows = components(spark.createDataFrame(edges, f"a {kind}, b {kind}")).collect()
    assert len(rows) == len({r.node for r in rows})
    return {r.node: r.component for r in rows}


def test_path_star_cycle_and_random(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 101 + i) for i in range(30)] + [(500, 99)]
    ring = [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    rng = random.Random(1)
    loose = [(rng.randint(1000, 1100), rng.randint(1000, 1100)) for _ in range(70)]
    loose = [(a, b) for a, b in loose if a != b]
    edges = path + star + ring + loose
    assert ours(spark, edges) == plain(edges)


def test_nulls_loops_repeats_and_nothing(spark):
    assert ours(spark, [(1, 1), (2, None), (None, 3), (5, 4), (4, 5), (5, 4)]) == {4: 4, 5: 4}
    assert ours(spark, []) == {}


def test_text_nodes(spark):
    assert ours(spark, [("b", "a"), ("c", "b")], "string") == {"a": "a", "b": "a", "c": "a"}

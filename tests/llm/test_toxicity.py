import random
import zlib

import numpy as np

from tenura.llm import toxicity as tox


def corpus(n=900, seed=1):
    """Clean and toxic texts; every third clean text and most toxic ones mention a group."""
    rng = random.Random(seed)
    common = [f"word{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(common) for _ in range(rng.randint(5, 120))]
        bad = rng.random() < 0.3
        if bad:
            for w in rng.sample(["idiot", "Scum!", "moron,", "vilebeast" + rng.choice("abcde")], 2):
                words.insert(rng.randrange(len(words)), w)
            if rng.random() < 0.7:
                words.insert(0, "muslims")
        elif rng.random() < 0.03:
            words.insert(0, "muslims")
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return docs, labels


def frames(spark, docs_of, docs, labels):
    return docs_of(docs, {"score": "q", "y": "q"}), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_held_out_rows_are_told_apart(spark, docs_of):
    docs, labels = corpus()
    d, lab = frames(spark, docs_of, docs, labels)
    out = {r.doc_id: r for r in tox.score_texts(d, tox.train(d, lab)).collect()}
    assert len(out) == len(docs)
    truth = {i: y for i, _, y in labels}
    test = [i for i in truth if held(i)]
    assert all(out[i].held_out == held(i) for i in truth)
    assert sum(out[i].predicted == truth[i] for i in test) >= 0.97 * len(test)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out.values())


def test_labels_of_held_out_rows_are_not_learnt(spark, docs_of):
    docs, labels = corpus(400)
    d, lab = frames(spark, docs_of, docs, labels)
    _, flipped = frames(spark, docs_of, docs, [(i, q, 1 - y if held(i) else y) for i, q, y in labels])
    assert tox.train(d, lab) == tox.train(d, flipped)


def test_swaps_lower_false_positives_on_neutral_mentions(spark, docs_of):
    docs, labels = corpus()
    d, lab = frames(spark, docs_of, docs, labels)
    neutral = [f"word{i} muslims word{i + 1} word{i + 2}" for i in range(50)]
    def score(model):
        cache = tox._WordWeights(model.weights)
        return np.mean([model.score(t, cache) for t in neutral])
    with_swaps, without = tox.train(d, lab), tox.train(d, lab, swap_penalty=0.0)
    assert score(with_swaps) < score(without) and score(with_swaps) < 0.5
    twin = lambda m: abs(score(m) - np.mean([m.score(t.replace("muslims", "hindus"), tox._WordWeights(m.weights)) for t in neutral]))
    assert twin(with_swaps) < twin(without)


def test_swapping_keeps_the_other_words():
    twins = tox.swapped({"the", "muslims", "x"})
    assert len(twins) == len(tox.IDENTITY_TERMS[1]) - 1
    assert all(t - set(tox.IDENTITY_TERMS[1]) == {"the", "x"} and "muslims" not in t for t in twins)
    assert set().union(*twins) == {"the", "x", *tox.IDENTITY_TERMS[1]} - {"muslims"} and tox.swapped({"nothing"}) == []


def test_texts_without_a_term_are_compared_in_copies():
    words, twins = tox.counterfactuals({"nothing", "here"})
    [term] = words - {"nothing", "here"}
    row = next(r for r in tox.IDENTITY_TERMS if term in r)
    assert set().union(*twins) - {"nothing", "here"} == set(row) - {term}
    assert tox.counterfactuals({"nothing", "here"}) == (words, twins)
    assert tox.counterfactuals({"gay", "x"})[0] == {"gay", "x"}


def test_inserted_pairs_act_where_no_text_holds_a_term(spark, docs_of):
    """Toxic words that begin like a group's name: without pairs a neutral mention takes over their weight."""
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(900):
        words = [f"word{rng.randint(0, 300)}" for _ in range(rng.randint(5, 60))]
        bad = i % 3 == 0
        if bad:
            words.insert(rng.randrange(len(words)), "muslix" + rng.choice("abcdefgh"))
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    assert not any(tox.swapped(set(t.split())) for _, t in docs)
    d, lab = frames(spark, docs_of, docs, labels)
    models = [tox.train(d, lab, swap_penalty=x) for x in (5.0, 0.0)]
    with_pairs, without = ({r.toxic: r for r in tox.counterfactual_gap(d, lab, m).collect()} for m in models)
    assert with_pairs[0].pairs == without[0].pairs > 0
    assert with_pairs[0].mean_gap < 0.5 * without[0].mean_gap
    out = {r.doc_id: r.predicted for r in tox.score_texts(d, models[0]).collect()}
    truth = {i: y for i, _, y in labels}
    assert sum(out[i] == truth[i] for i in truth if held(i)) >= 0.97 * sum(map(held, truth))


def test_one_hot_id_does_not_fill_the_sample(spark, docs_of):
    docs, labels = corpus(300)
    hot = next(i for i, _, y in labels if y == 0 and not held(i))
    d, lab = frames(spark, docs_of, docs + [(hot, f"word{k % 300} other{k}") for k in range(3000)], labels + [(hot, 1, 0)] * 500)
    seen = []
    fit = tox.fit_weights
    tox.fit_weights = lambda y, rows, *a, **k: seen.append((len(rows), k["times"].max())) or fit(y, rows, *a, **k)
    try:
        tox.train(d, lab, max_rows=400)
    finally:
        tox.fit_weights = fit
    assert seen[0][0] < 600 and seen[0][1] >= 500


def test_gradient_is_that_of_the_objective():
    rng = np.random.RandomState(1)
    rows = [sorted(set(rng.randint(0, 6, 3).tolist())) for _ in range(40)]
    twins = [sorted(set(rng.randint(0, 6, 3).tolist())) if k % 3 == 0 else None for k in range(40)]
    y = rng.randint(0, 2, 40)

    def loss(w, b, penalty=5.0, l2=1e-3):
        p = lambda r: 1 / (1 + np.exp(-(w[r].sum() + b)))
        n1, total = y.sum(), 0.0
        for r, t in zip(rows, y):
            total -= (0.5 / n1) * np.log(p(r)) if t else (0.5 / (len(y) - n1)) * np.log(1 - p(r))
        pairs = [(r, t) for r, t in zip(rows, twins) if t is not None]
        return total + penalty * np.mean([(p(r) - p(t)) ** 2 for r, t in pairs]) + l2 * (w @ w) / 2

    w, b = tox.fit_weights(y, rows, twins, 6, steps=3000)
    for k in range(7):
        step = np.zeros(7)
        step[k] = 0.05
        assert loss(w, b) <= loss(w + step[:6], b + step[6]) and loss(w, b) <= loss(w - step[:6], b - step[6])


def test_odd_rows_and_tables(spark, docs_of):
    docs, labels = corpus(300)
    odd = [(None, "idiot moron scum"), (5000, None), (5001, ""), (5002, "word1 " * 100_000), (5003, "idiot moron"), (5003, "idiot moron")]
    d, lab = frames(spark, docs_of, docs + odd, labels + [(None, 1, 1), (5001, None, None), (5002, 1, 7)])
    out = [r for r in tox.score_texts(d, tox.train(d, lab)).collect() if r.doc_id is None or r.doc_id >= 5000]
    assert len(out) == 6
    by = {(r.doc_id, r.predicted) for r in out}
    assert by == {(None, 1), (5000, 0), (5001, 0), (5002, 0), (5003, 1)}
    assert not any(r.held_out for r in out if r.doc_id is None)
    model = tox.train(d, lab)
    kept = tox.reject_toxic(d, model)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} >= {5000, 5001, 5002}
    assert None not in {r.doc_id for r in kept.collect()}


def test_without_labels_nothing_is_rejected(spark, docs_of):
    docs, labels = corpus(50)
    d, none = frames(spark, docs_of, docs, [])
    assert {r.predicted for r in tox.score_texts(d, tox.train(d, none)).collect()} == {0}
    _, clean = frames(spark, docs_of, docs, [(i, q, 0) for i, q, _ in labels])
    assert {r.predicted for r in tox.score_texts(d, tox.train(d, clean)).collect()} == {0}
    empty, lab = frames(spark, docs_of, [], labels)
    assert tox.score_texts(empty, tox.train(empty, lab)).collect() == []

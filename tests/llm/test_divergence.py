import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tenura.llm import divergence
from tenura.llm.divergence import Sizes

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id long, text string, lang string, source string, extra string, n long"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(rows, min_docs, top=50):
    """The audit by the definition: rows of (doc_id, text, lang, source)."""
    rows = [(terms(t), l or "", s or "") for _, t, l, s in rows]
    out = []
    for lang in {l for _, l, _ in rows}:
        docs = Counter(t for ts, l, _ in rows if l == lang for t in set(ts))
        kept = {t for t, n in docs.items() if n >= min_docs}
        counts = defaultdict(Counter)
        for ts, l, s in rows:
            if l == lang:
                counts[s].update(t for t in ts if t in kept)
        def shares(c):
            total = sum(c.values()) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // total for t in kept}
        p = {s: shares(c) for s, c in counts.items()}
        q = shares(sum(counts.values(), Counter()))
        for s in p:
            pairs = [(r, sum(abs(p[s][t] - p[r][t]) for t in kept)) for r in p if r != s]
            more = [(t, p[s][t] - q[t]) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", more, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(found[:most], 1)]
    return sorted(out)


def rows_of(rng, n, langs=("en", "de", None, ""), sources=("a", "b", "c", None, "é", "")):
    vocabulary = ["the", "The", "the,", "of", "OF", "don't", "x-y-x", "é", "É", "ünd", "漢字", "a\xa0b", "a b", "...", "12", "a1b", "(The)", "k" * 300,
                  "-".join(["p", "q"] * 200), "Σ", "ſ"]
    gaps = [" ", "\n", "\t", "\x0b", "\x1c", "\x85", "  ", "\r\n"]
    return [(i, rng.choice([None, ""]) if rng.random() < 0.1 else "".join(rng.choice(vocabulary) + rng.choice(gaps) for _ in range(rng.randint(1, 40))),
             rng.choice(langs), rng.choice(sources)) for i in range(n)]


def audit(spark, rows, min_docs, **more):
    df = spark.createDataFrame([(*r, "q", 1) for r in rows], DOCS)
    out = divergence.audit(df, min_docs=min_docs, **more)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("sizes", [Sizes(), Sizes(rows=7, terms=2, sources=2), Sizes(text_bytes=200, sources=1)])
def test_like_the_definition(spark, sizes):
    rows = rows_of(random.Random(sizes.rows), 150)
    rows += rows[:3] + [(None, "the of of", "en", "a"), (None, None, None, None), (9000, "lonely", "xx", "one"), (9001, "", "yy", "one"),
                        (9002, "words nobody else has", "yy", "two")]
    min_docs = 3 if sizes.terms == 2 else 12
    assert audit(spark, rows, min_docs, sizes=sizes) == plain(rows, min_docs)


def test_tops_ties_and_empty_tables(spark):
    rows = [(i, " ".join(f"w{chr(97 + k)}" for k in range(26)) + (" more" if i % 2 else " less"), "en", "ab"[i % 2]) for i in range(12)]
    assert audit(spark, rows, 2, top=3) == plain(rows, 2, top=3)
    rows = [(0, "x y", "en", "a")]
    assert audit(spark, rows, 1) == plain(rows, 1)
    assert audit(spark, [], 1) == []


def test_a_document_counts_once_for_all_chunks_of_a_term(spark):
    rows = [(i, "The the THE the, (the)", "en", "a") for i in range(3)]
    assert audit(spark, rows, 4) == [] and plain(rows, 4) == []
    counts = divergence.term_counts(spark.createDataFrame([(*r, "q", 1) for r in rows], DOCS), 3).collect()
    assert [tuple(r) for r in counts] == [("en", "a", "the", 15)]


def test_shares_are_exact_at_size(spark):
    from pyspark.sql import functions as F

    n, total, v = 9 * 10**15, 4 * 10**18, 10**9
    got = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(v)).alias("p"),
                                divergence.share(F.lit(0), F.lit(0), F.lit(0)).alias("none")).head()
    assert got.p == 1 + 10**9 * (n + 5) // (total + 5 * v) and got.none is None


def test_chunks_of_one_part_by_brute_force():
    rng = random.Random(2)
    rows = rows_of(rng, 40, ("en", "de"), ("a", "b"))
    batch = pa.RecordBatch.from_pydict({"lang": [r[2] for r in rows], "source": [r[3] for r in rows], "text": [r[1] or "" for r in rows]})
    got = {(r["lang"], r["chunk"]): r for r in divergence.count_chunks(batch, 5).to_pylist()}
    want, by_source = defaultdict(set), defaultdict(Counter)
    for k, (_, text, lang, source) in enumerate(rows):
        for chunk in re.split("[\t-\r ]+", text or ""):
            pieces = re.split(r"[\x00-\x40\x5B-\x60\x7B-\x7F]+", chunk) if len(chunk) > 256 else [chunk]
            for piece in pieces:
                if piece:
                    want[lang, piece].add(k)
                    by_source[lang, piece][source] += 1
    assert set(got) == set(want)
    for key, r in got.items():
        assert r["docs"] == sorted(want[key]) and dict(zip(r["sources"], r["ns"])) == by_source[key] and r["part_of"] == 5


def test_parts_are_bounded():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * n for n in (10, 10, 10, 10, 10, 500, 60, 50, 0, 0, 0, 0, 0)]})
    parts = [p.column("text").to_pylist() for p in divergence._parts(batch, Sizes(text_bytes=100, rows=4))]
    assert sum(parts, []) == batch.column("text").to_pylist()
    assert all(len(p) <= 4 and (len(p) == 1 or sum(map(len, p)) <= 100) for p in parts)


def test_many_groups_in_cells():
    rng = np.random.default_rng(1)
    shares = rng.integers(1, 1000, (5, 6))
    rows = [(g, f"t{t}", shares[g, t]) for g in range(5) for t in range(6)] + [(g, None, g * g) for g in range(5)]
    table = {"lang": ["en"] * len(rows), "slice": [0] * len(rows), "block_i": [0] * len(rows), "block_j": [0] * len(rows),
             "g": [r[0] for r in rows], "term": [r[1] for r in rows], "p": [r[2] for r in rows], "n_terms": [8] * len(rows)}
    out = list(divergence._cell_distances(64, iter([pa.RecordBatch.from_pydict(table)])))[0].to_pylist()
    assert {(r["a"], r["b"]): r["f"] for r in out} == {(a, b): int(np.abs(shares[a] - shares[b]).sum()) + 2 * (b * b - a * a) for a in range(5) for b in range(a + 1, 5)}


def test_chunks_are_taken_apart_without_a_join(spark, monkeypatch):
    plans, written = [], divergence.written_table

    def seen(session, df):
        plans.append((df.columns, df._jdf.queryExecution().optimizedPlan().toString()))
        return written(session, df)

    monkeypatch.setattr(divergence, "written_table", seen)
    rows = [(i, "The the (the) of-of-of of", "de" if i % 2 else "en", "a") for i in range(6)]
    got = divergence.term_counts(spark.createDataFrame([(*r, "q", 1) for r in rows], DOCS), 3).collect()
    assert sorted(tuple(r) for r in got) == [(g, "a", t, n) for g in ("de", "en") for t, n in (("of", 12), ("the", 9))]
    plan, = [p for c, p in plans if "times" in c and "held" in c]
    assert "Join" not in plan

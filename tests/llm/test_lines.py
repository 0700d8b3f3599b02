from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tenura.llm.lines import dedup_lines

LONG = "This Line Is Long Enough To Count As Shared Boilerplate"


def plain(rows, min_chars=40, min_docs=5):
    """The same by brute force."""
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\f\r"))
    order = lambda d: (d is not None, d or 0)
    holders = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(d)
    stays = {k: max(v, key=order) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in stays or stays[key(x)] == d]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def ours(df):
    return sorted([(r.doc_id, r.line_dedup.n_lines, r.line_dedup.n_dropped, r.line_dedup.kept)
                   for r in dedup_lines(df).collect()], key=repr)


def test_shared_lines_stay_in_the_largest_document(docs_of):
    rows = [(i, f"own {i}\n  {LONG if i % 2 else LONG.upper()}\t\nlast") for i in range(6)]
    assert ours(docs_of(rows)) == plain(rows)
    assert [r[2] for r in ours(docs_of(rows))] == [1, 1, 1, 1, 1, 0]


def test_four_documents_are_too_few_and_short_keys_do_not_count(docs_of):
    rows = [(i, f"{LONG}\nshort line") for i in range(4)] + [(i, "short line") for i in range(4, 9)]
    assert all(r[2] == 0 for r in ours(docs_of(rows)))


def test_code_points_not_bytes_make_the_length(docs_of):
    short, enough = "é" * 39, "é" * 40
    assert all(r[2] == 0 for r in ours(docs_of([(i, short) for i in range(6)])))
    assert sum(r[2] for r in ours(docs_of([(i, enough) for i in range(6)]))) == 5


def test_only_ascii_letters_are_lowered(docs_of):
    rows = [(i, "É" * 45) for i in range(3)] + [(i, "é" * 45) for i in range(3, 6)]
    assert all(r[2] == 0 for r in ours(docs_of(rows)))


def test_nulls_empty_repeats_and_long_texts(docs_of):
    rows = [(None, LONG), (None, None), (1, LONG), (1, LONG), (1, f"{LONG}\n{LONG}"), (2, LONG), (3, LONG), (4, LONG), (5, ""), (6, None),
            (7, "\n".join(f"line {i}" for i in range(30_000)) + "\n" + LONG)]
    assert ours(docs_of(rows)) == plain(rows)


def test_line_repeated_inside_one_document_is_one_document(docs_of):
    assert all(r[2] == 0 for r in ours(docs_of([(1, "\n".join([LONG] * 9))])))


def test_empty_table_and_clashing_columns(docs_of):
    assert ours(docs_of([])) == []
    names = {c: c for c in ("d", "t", "row", "lines", "pos", "key", "k1", "gone_flags", "stays", "n")}
    out = dedup_lines(docs_of([(i, LONG) for i in range(6)], names))
    assert out.columns[:-1] == ["doc_id", "text", "lang", "source", "n_chars", *names]
    assert sorted(r.line_dedup.n_dropped for r in out.collect()) == [0, 1, 1, 1, 1, 1]
    assert {r["gone_flags"] for r in out.collect()} == {"gone_flags"}


def test_no_python_in_the_plan(docs_of):
    plan = dedup_lines(docs_of([(1, LONG)]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.lists(st.sampled_from(["a" * 40, " A" + "a" * 39, "b" * 41, "x", "", "É" * 40]), max_size=5)
                          .map("\n".join)), max_size=14))
def test_like_brute_force(docs_of, rows):
    assert ours(docs_of(rows)) == plain(rows)

import hashlib
import random
import re

import pytest

from tenura.llm import fim
from tests.llm.conftest import sha

ODD = ["", "\n", "\n\n\n", "a", "a\n", "a\nb", "a\nb\n", "é\n漢字\n😀", "x<P>y\nz", "<\nP>\n", "<S\n>", "<M>", "<P", "<\n<P\n>S>\n<", "\r\n\r\n",
       "a\x0bb\x0cc\x85d e\n", "<<P\n><<S\n>><M\n"]


def plain(doc_id, text, rates=fim.Rates()):
    """The rule written down over code points."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    hexes = hashlib.sha256(f"{rates.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexes[k:k + 8], 16) for k in (0, 8, 16, 24)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rates.rotated:
        return n, "plain", None, None, text
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:lo], units[lo:hi], units[hi:]))
    if h[3] % 100 < rates.suffix_first:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def random_text(rng):
    return "".join(rng.choice(["a", "é", "\n", "<", ">", "P", "S", "M", "<P", "漢", " ", "\n\n", "😀", "\r"]) for _ in range(rng.randint(0, 30)))


def test_like_the_rule_and_back():
    rng = random.Random(3)
    rates = [fim.Rates(), fim.Rates(seed=1, rotated=50, suffix_first=0), fim.Rates(seed=2, suffix_first=100), fim.Rates(rotated=0)]
    seen = set()
    for text in ODD + [random_text(rng) for _ in range(4000)]:
        doc, rate = rng.choice([None, 0, -5, rng.getrandbits(62)]), rng.choice(rates)
        *got, out = fim.rotate(text.encode(), doc, rate)
        assert (*got, out.decode()) == plain(doc, text, rate), (doc, text)
        assert fim.restore(out, got[1]) == text.encode(), text
        seen.add(got[1])
    assert seen == {"plain", "psm", "spm"}


@pytest.mark.parametrize("step", [1, 2, 3, 7, 1 << 16])
def test_exchange_by_reversals(monkeypatch, step):
    monkeypatch.setattr(fim, "STEP", step)
    rng = random.Random(step)
    for _ in range(300):
        data = bytes(rng.getrandbits(8) for _ in range(rng.randint(0, 40)))
        a, b, c = sorted(rng.randint(0, len(data)) for _ in range(3))
        buffer = bytearray(data)
        fim.exchange(buffer, a, b, c)
        assert buffer == data[:a] + data[b:c] + data[a:b] + data[c:]


def test_reversal_holds_one_step_beside_the_buffer():
    import tracemalloc

    buffer = bytearray(40_000_000)
    buffer[5:8] = b"abc"
    tracemalloc.start()
    fim.exchange(buffer, 0, 13_000_001, len(buffer))
    assert tracemalloc.get_traced_memory()[1] < 4 * fim.STEP
    tracemalloc.stop()
    at = len(buffer) - 13_000_001 + 5
    assert buffer[at:at + 3] == b"abc"


def test_broken_outputs_are_errors():
    for out, form in [(b"<P>a<M>b", "psm"), (b"x<P>a<S>b<M>c", "psm"), (b"<P>a<S>b<M>c", "spm"), (b"a", "other")]:
        with pytest.raises(ValueError):
            fim.restore(out, form)


def test_table_with_nulls_repeats_long_texts_and_clashes(spark, docs_of, monkeypatch):
    rng = random.Random(4)
    rows = [(1, None), (2, ""), (None, "a\nb\nc"), (3, "x\ny\n"), (3, "x\ny\n"), (4, "word é\n" * 400_000), (5, "z" * 3_000_000)]
    rows += list(enumerate(ODD + [random_text(rng) for _ in range(100)], 10))
    out = fim.restored(fim.fill_in_middle(docs_of(rows, {"output": "q", "n": "q", "form": "q"}))).collect()
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, sha(r.output), sha(r.restored)) for r in out), key=repr)
    want = sorted(((d, *plain(d, t)[:4], sha(plain(d, t)[4]), sha(t or "")) for d, t in rows), key=repr)
    assert got == want
    assert fim.restored(fim.fill_in_middle(docs_of([]))).collect() == []


def test_small_batches_of_output(monkeypatch):
    monkeypatch.setattr(fim, "BATCH_BYTES", 10)
    rows = [(i, 1, "plain", None, None, b"x" * i) for i in range(20)]
    batches = list(fim._handed_on(iter(rows), fim.ROTATED))
    assert len(batches) > 3 and sum(b.num_rows for b in batches) == 20
    assert [r["output"] for b in batches for r in b.to_pylist()] == ["x" * i for i in range(20)]

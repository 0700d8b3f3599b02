import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tenura.llm import packing
from tenura.llm.queries import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check(rows, out, library, window):
    want = Counter()
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        for s in range(0, len(ids), window):
            part = ids[s:s + window]
            want[d, s, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out) == want
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append(r)
    padding = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
        padding += packing.padding(at, window)
    return padding, len(sequences)


def test_ids_are_the_tokenizers(library):
    words = packing.WordIds(PATH)
    odd = ["", " ", "Hello, World. It's 42!!", "a.,b x., y,. z..", "ΣΑΣ ὈΔΥΣΣΕΎΣ", "é é É İı", "<|endoftext|>, <|startoftext|>x.",
           "tab\tand\nline\r\nend\x0b\x0c\x85\xa0 x\x1cy", "don't we'll I'M 'S", "漢字 かな 😀 ok", "x" * 500 + ".", "1.5 3,000, a1. 1a,"]
    rng = random.Random(5)
    odd += ["".join(rng.choice("aZé.,'! \n\t\xa0Σs12<|>") for _ in range(30)) for _ in range(2000)]
    for text in odd:
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(words.of(text), "<u4").tolist() == want, text


def test_added_tokens_count_in_their_own_case_only(spark, docs_of, library):
    words = packing.WordIds(PATH)
    odd = ["<|ENDOFTEXT|>", "a <|EndOfText|> b", "A. <|StartOfText|>X, <|endoftext|>Y. É", "<|STARTOFTEXT|>.", "x<|endoftext|>X <|EndOfText|",
           "Σ <|EndOfText|> b"]
    rng = random.Random(6)
    parts = ["<|EndOfText|>", "<|endoftext|>", "<|STARTOFTEXT|>", "Word", "É.", "X,", " ", "\n", "<|", "|>"]
    odd += ["".join(rng.choice(parts) for _ in range(12)) for _ in range(500)]
    for text in odd:
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(words.of(text), "<u4").tolist() == want, text
    rows = list(enumerate(odd[:6]))
    check(rows, packing.pack(docs_of(rows), PATH, window=64).collect(), library, 64)


def test_table_is_emptied_when_full(library):
    words = packing.WordIds(PATH, room=5)
    text = " ".join(f"word{i}, other{i}." for i in range(50))
    assert np.frombuffer(words.of(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(words) <= 8


def test_every_piece_in_one_place_with_nulls_repeats_and_long_texts(spark, docs_of, library):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["alpha", "Beta,", "gamma.", "Überzug"]) for _ in range(rng.randint(0, 90)))) for i in range(60)]
    rows += [(None, "no id"), (7, None), (8, ""), (9, "same text"), (9, "same text"), (10, "word " * 5000)]
    out = packing.pack(docs_of(rows, {"length": "x", "bucket": "y"}), PATH, window=64).collect()
    padding, n = check(rows, out, library, 64)
    assert padding <= 0.02 * 64 * n


def test_empty_table(docs_of):
    assert packing.pack(docs_of([]), PATH).collect() == []


def test_one_length_for_all(docs_of, library):
    rows = [(i, "one two three") for i in range(300)]
    padding, _ = check(rows, packing.pack(docs_of(rows), PATH, window=64).collect(), library, 64)
    assert padding == 0


def reachable(counts, window):
    """Best padding with the longest length in, by trying all multisets."""
    longest = max(counts)
    left = Counter(counts)
    left[longest] -= 1
    sums = {longest}
    for length, n in left.items():
        sums = {s + k * length for s in sums for k in range(n + 1) if s + k * length <= window}
    return min(packing.padding(s, window) for s in sums)


def test_fill_is_the_closest_possible():
    rng = random.Random(2)
    for _ in range(300):
        counts = {rng.randint(1, 50): rng.randint(1, 4) for _ in range(rng.randint(1, 6))}
        window = 64
        used = packing.best_fill(counts, window)
        assert max(counts) in used and all(0 < n <= counts[k] for k, n in used.items())
        total = sum(k * n for k, n in used.items())
        assert total <= window and packing.padding(total, window) == reachable(counts, window)


def test_plan_does_not_grow_with_the_number_of_documents():
    rng = random.Random(3)
    counts = {k: rng.randint(1, 20) for k in rng.sample(range(1, 2048), 400)}
    small, large = (packing.plan_windows({k: n * f for k, n in counts.items()}, 2048) for f in (1, 100_000))
    assert len(large) < 4 * len(small) + 2000
    for plan, f in ((small, 1), (large, 100_000)):
        seats = Counter()
        for length, a, b, *_ in plan:
            assert a == seats[length]
            seats[length] = b + 1
        assert seats == {k: n * f for k, n in counts.items()}


def test_table_stays_small_and_new_words_go_to_the_model(library):
    words = packing.WordIds(PATH)
    assert words.half <= 200_000  # two workers of an executor keep one each, from task to task
    calls = []
    words.tokenizer = type("Counted", (), {"encode": lambda self, run, **how: calls.append(run) or library.encode(run, **how)})()
    text = "Plainword überquerung, çonen ªº µm ÿ straße. naïve&& l'eau x² don't É."
    assert np.frombuffer(words.of(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert {"plainword", "überquerung", "çonen", "straße", "ÿ"}.isdisjoint(calls) and "naïve&&" in calls
    words.of("of, of, of,")
    assert "überquerung," not in words and "überquerung" in words and "of," in words


def test_a_worker_keeps_the_table_of_one_operator():
    from tenura.llm import common
    from tenura.llm.forest import WordHashes, shingles

    table = common.worker_table("a", dict)
    assert common.worker_table("a", dict) is table
    shingles("one two", 5)
    assert list(common._tables) == [WordHashes]
    assert common.worker_table("none", None) is None and not common._tables

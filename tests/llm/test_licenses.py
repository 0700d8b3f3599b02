import random
import re

from tenura.llm.licenses import NOTICES, Scanner, pieces, scan_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def plain(text):
    """The base search by brute force."""
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places = [(i, label) for phrase, label in BASE.items() for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    return (len(words), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None),
            ",".join(sorted({x for _, x in places})))


def test_base_like_brute_force():
    scanner, rng = Scanner(), random.Random(7)
    parts = ["MIT", "License", "mit-license", "licence", "Apache", "general", "PUBLIC", "license", "ölicense", "x", "2", "mitlicense", "the"]
    texts = ["".join(rng.choice(parts) + rng.choice([" ", "\n", "--", "  ", ", "]) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    texts += ["mit license " * 3000, "", "MIT", "MIT\x00License", "é mit license é", "mit license", "mit licenses"]
    for text in texts:
        assert scanner.scan(text)[:5] == plain(text), text[:100]


def test_errors_are_found_and_counted():
    out = Scanner().scan("Foo. Relesed under teh MIT License. Bar")
    found = [s for s in out[7] if s["notice"] == "released under the mit license"]
    assert len(found) == 1 and 0 < found[0]["edits"] <= 3 and found[0]["first_word"] == 1
    assert out[5].split(",") == ["mit"] and 0.8 < out[6] <= 1
    assert Scanner().scan("Mozila Public Licence")[5] == "mpl" and Scanner().scan("Mozila Public Licence")[4] == ""
    assert Scanner().scan("nothing of the kind here")[6] == 0


def test_every_match_within_the_errors_is_located():
    """Planted notices with random edits inside words: one piece is always unchanged, so the stretch is always looked at."""
    scanner, rng = Scanner(), random.Random(9)
    for _ in range(1500):
        n = rng.choice(NOTICES)
        text = list(n.words)
        for _ in range(n.errors):
            k = rng.choice([k for k, c in enumerate(text) if c != " " and 0 < k < len(text) - 1])
            text[k:k + rng.randint(0, 1)] = rng.choice(["", "q", "z"])
        text = "aaa bbb " + "".join(text) + " ccc ddd"
        assert any(scanner.notices[k] is n for k, *_ in scanner.matches(text)), (n.words, text)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left = row[0]
        row[0] = i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(left + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def test_labels_like_edit_distances_of_word_windows():
    """Every window of as many words as a notice, compared with it by brute force."""
    scanner, rng = Scanner(), random.Random(12)
    words = sorted({w for n in NOTICES for w in n.words.split()}) + ["permit", "unit", "hall", "licensed", "sublicense", "fees", "mitt", "lisense"]
    for _ in range(1500):
        text = rng.choices(words, k=rng.randint(1, 12))
        n = rng.choice(NOTICES)
        at = rng.randint(0, len(text))
        text[at:at] = n.words.split()
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(text))
            c = rng.randrange(len(text[k]))
            text[k] = text[k][:c] + rng.choice(["", "q", text[k][c] * 2]) + text[k][c + 1:] or "q"
        windows = {(n.words, i) for n in NOTICES for w in [n.words.split()] for i in range(len(text) - len(w) + 1)
                   if sum(distance(x, y) for x, y in zip(w, text[i:i + len(w)])) <= n.errors}
        found = {(s["notice"], s["first_word"]) for s in scanner.scan(" ".join(text))[7]}
        assert {n for n, _ in windows} == {n for n, _ in found}, text
        assert found <= windows, text


def test_no_label_from_inside_words():
    for text in ("permit license fees", "submit license forms", "the unit license", "the ability licensed under the act", "keit licensed under",
                 "small rights reserved", "mi tlicense", "apachelicense", "overall rights reserved", "general publicity licenses"):
        assert Scanner().scan(text)[5:7] == ("", 0.0), text
    assert Scanner().scan("x " * 10 + "a" * 1_000_000 + "mit license" + "b" * 1_000_000)[5] == ""


def test_pieces_cover_the_notice():
    assert "".join(p for _, p in pieces("apache license", 3)) == "apache license"
    assert len(pieces("apache license", 3)) == 4


def test_table_with_nulls_repeats_long_texts_and_clashes(spark, docs_of):
    rows = [(1, None), (2, ""), (None, "MIT License"), (3, "x y"), (3, "x y"), (4, "word " * 200_000 + "Apache License")]
    out = scan_licenses(docs_of(rows, {"labels": "q", "n_words": "q"})).collect()
    assert sorted([(r.doc_id, *tuple(r)[1:6]) for r in out], key=repr) == sorted([(d, *plain(t)) for d, t in rows], key=repr)
    assert scan_licenses(docs_of([])).collect() == []

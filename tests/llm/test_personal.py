import random
import re

import duckdb
import pandas as pd

from tenura.llm import personal
from tenura.llm.queries import PERSONAL_SQL
from tests.llm.conftest import sha

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "account": r"(?i:account|acct)(?i: (?:number|no\.?))?[:# ]{1,3}(?P<value>[0-9]+)",
    "iban": r"(?i:iban)[: ]{1,3}(?P<value>[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)",
    "url": r"[A-Za-z][A-Za-z0-9+.-]*://[A-Za-z0-9._~%!$&'*+,;=:-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*",
}


def valid(kind, text, m):
    digits = re.sub("[^0-9]", "", m[0])
    if kind == "ip":
        return all(re.fullmatch("0*([0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])", p) for p in m[0].split("."))
    if kind == "card":
        doubled = [int(d) * (1 + k % 2) for k, d in enumerate(digits[::-1])]
        return 16 <= len(digits) <= 19 and sum(n // 10 + n % 10 for n in doubled) % 10 == 0
    if kind == "phone":
        return 8 <= len(digits) <= 15
    if kind == "account":
        return 6 <= len(digits) <= 17
    if kind == "iban":
        number = m["value"].replace(" ", "")
        turned = "".join(str("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ".index(c)) for c in number[4:] + number[:4])
        return not re.match("[A-Za-z0-9]", text[m.end():]) and 15 <= len(number) <= 34 and int(turned) % 97 == 1
    return True


def plain(text):
    """Every pattern over the whole text."""
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or "", re.ASCII):
            if valid(kind, text, m):
                value = "value" if "value" in m.groupdict() else 0
                out.append((kind, m.start(value), m.end(value)))
    return out


PARTS = ["a", "Z", "9", "0", "12", "255", "256", "4111", "1111", "@", "@", ".", ".", "-", " ", "+", "+4", "(", ")", "%", "_", "\n", "é", "😀", "://",
         "http://", "u:p", "account", "Acct no.", "ACCOUNT number", ": ", "#", "iban", "IBAN ", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432",
         "4111 1111 1111 1111", "4111-1111-1111-1111", "10.0.0.1", "+1 (988) 555-2485", "x.y@mail.example.com", "/", "'", "ſ", "K"]
WHOLE = ["", "@", "a@b", "a@b.c", "a@b.c@d.e", "a@b..c", "a@b.c.", "@b.c", "é@b.c", "éa@b.c", "1.2.3.4.5.6.7.8", "1.2.3.4.5.6.7", "1.2.3", "256.1.1.1.1",
         "1..2.3.4.5", "000255.1.1.1", "1" * 5000 + ".1.1.1", "+1 2", "+12", "+1 (2", "+1-2-3-4-5-6-7-8", "+1+2 34567890", "4111111111111111",
         "4111 1111  1111 1111", "411111111111111100000", "1-1-1-1", "iban: DE89 3704 0044 0532 0130 00 x", "iban DE89 3704 0044 0532 0130 00X",
         "IBAN GB82 WEST 1234 5698 7654 32", "iBaN:GB82WEST12345698765432.", "account 123456", "account no 12345", "acct#:# 1234567890123456789",
         "ftp://bob:pw@host.example/x", "1http://u@h", "x+y://u@h.i.j:80", "://u@h", "a://u@h://v@i", "http://a.b/c"]


def texts(n, seed=5):
    rng = random.Random(seed)
    return WHOLE + ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 14))) for _ in range(n)]


def test_like_patterns_over_whole_texts():
    finder, kinds = personal.Finder(), set()
    for text in texts(20_000):
        got = finder.find(text)
        assert got == plain(text), text
        kinds |= {k for k, *_ in got}
    assert kinds == set(personal.KINDS)


def test_plain_prose_has_none():
    text = "In 2024 the 3 of 12,500 words cost 4.50 and 10-20 more. Account of the war; iban is a word: see 1.2.3 or a @ b.\n" * 50
    assert personal.Finder().find(text) == []


def test_long_runs_take_linear_time():
    finder = personal.Finder()
    for unit in ("a", "1", "1.", "+1 ", "a@", "1 ", "://", "account "):
        assert isinstance(finder.find(unit * (2_000_000 // len(unit))), list)


def test_sql_finds_the_same():
    documents = pd.DataFrame({"doc_id": range(len(texts(1500, 6))), "text": texts(1500, 6)})
    documents.loc[3, "text"] = None
    con = duckdb.connect()
    con.register("documents", documents)
    finder = personal.Finder()
    got = {r[0]: r[1:] for r in con.execute(PERSONAL_SQL).fetchall()}
    for doc, text in zip(documents.doc_id, documents.text):
        found = finder.find(text or "")
        spans = [f"{k}:{a}:{b}" for k, a, b in found]
        base = ",".join(s for s, (k, *_) in zip(spans, found) if k in personal.BASE_KINDS)
        counts = tuple(sum(k == kind for k, *_ in found) for kind in personal.BASE_KINDS)
        assert got[doc] == (*counts, sha(base), ",".join(spans)), text


def test_table_with_nulls_repeats_long_texts_and_clashes(spark, docs_of):
    long = "word é " * 300_000 + "joe@mail.example.com"
    rows = [(1, None), (2, ""), (None, "call +1 (988) 555-2485"), (3, "x@y.z"), (3, "x@y.z"), (4, long)]
    rows += list(enumerate(texts(100, 7), 10))
    out = personal.find_personal(docs_of(rows, {"spans": "q", "kind": "q"}))
    got = out.select("doc_id", "spans", personal.listed().alias("l"), personal.count_of("email").alias("n")).collect()
    want = [(d, [(k, a, b, (t or "")[a:b]) for k, a, b in plain(t or "")]) for d, t in rows]
    assert sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in got), key=repr) == sorted(want, key=repr)
    assert {r.l for r in got if r.doc_id == 3} == {"email:0:5"} and {r.n for r in got if r.doc_id == 4} == {1}
    assert personal.find_personal(docs_of([])).collect() == []

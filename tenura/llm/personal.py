"""Personal data in texts by anchor expansion.

One Aho-Corasick automaton finds short anchors: at-signs, `://`, a plus or a dot beside digits, neighbouring
digits, and the words that announce an account number. Around each anchor a parser of its kind reads to the left
and to the right as far as the kind's characters reach and checks what it got (octets, check digits, lengths).
Nothing else of a text is looked at in Python.

Every kind means the leftmost matches of its pattern that do not overlap; those that fail the check are dropped
and the search goes on behind them.
"""

import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.llm.common import text_column

#: Kinds in the order of their spans. The first four are the base.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "account", "iban", "url")

DIGITS = "0123456789"
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
# What follows an anchor, matched in place; possessive, so that nothing is read twice.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_OCTETS = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
_DIGIT_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])++")
_DIALLED = re.compile(r"[ ().0-9-]++")
_ACCOUNT = re.compile(r"(?:account|acct)(?: (?:number|no\.?))?[:# ]{1,3}([0-9]++)", re.IGNORECASE | re.ASCII)
_IBAN = re.compile(r"iban[: ]{1,3}((?-i:[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?))", re.IGNORECASE | re.ASCII)
_USER_HOST = re.compile(r"[A-Za-z0-9._~%!$&'*+,;=:-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) << (k & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def octet(part: str) -> bool:
    bare = part.lstrip("0")
    return len(bare) <= 3 and int(bare or "0") <= 255


def iban_rest(number: str) -> int:
    """Remainder of the account number with its head moved to the end, letters written as 10 to 35."""
    return int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97


# Parsers: (text, first place of the anchor, where the last match of this kind ended) to (start, end, valid) or None.

def _email(text: str, at: int, done: int):
    start = at
    while start > done and text[start - 1] in _LOCAL:
        start -= 1
    m = _DOMAIN.match(text, at + 1) if start < at else None
    return m and (start, m.end(), True)


def _ip(text: str, at: int, done: int):
    if at < done:
        return None
    start = at
    while start > done and text[start - 1] in DIGITS:
        start -= 1
    m = _OCTETS.match(text, start)
    return m and (start, m.end(), all(map(octet, m[0].split("."))))


def _card(text: str, at: int, done: int):
    if at < done:
        return None
    m = _DIGIT_CHAIN.match(text, at)
    digits = m[0].replace(" ", "").replace("-", "")
    return at, m.end(), 16 <= len(digits) <= 19 and luhn(digits)


def _phone(text: str, at: int, done: int):
    m = _DIALLED.match(text, at + 2)
    tail = m[0].rstrip(" ().-") if m else ""
    if len(tail) < 2:
        return None
    return at, at + 2 + len(tail), 8 <= 1 + sum(tail.count(d) for d in DIGITS) <= 15


def _account(text: str, at: int, done: int):
    m = _ACCOUNT.match(text, at) if at >= done else None
    return m and (m.start(1), m.end(), 6 <= m.end() - m.start(1) <= 17)


def _iban(text: str, at: int, done: int):
    m = _IBAN.match(text, at) if at >= done else None
    if m is None:
        return None
    number, after = m[1].replace(" ", ""), text[m.end():m.end() + 1]
    whole = not (after.isascii() and after.isalnum())
    return m.start(1), m.end(), whole and 15 <= len(number) <= 34 and iban_rest(number) == 1


def _url(text: str, at: int, done: int):
    start = at
    while start > done and text[start - 1] in _SCHEME:
        start -= 1
    while start < at and not (text[start].isascii() and text[start].isalpha()):
        start += 1
    m = _USER_HOST.match(text, at + 3) if start < at else None
    return m and (start, m.end(), True)


_PARSERS = {"email": _email, "ip": _ip, "card": _card, "phone": _phone, "account": _account, "iban": _iban, "url": _url}


def anchors() -> dict[str, list[str]]:
    """Anchor strings by kind; an announcing word in every mixture of cases."""
    def cases(word: str) -> list[str]:
        return ["".join(c) for c in itertools.product(*((c, c.upper()) for c in word))]

    pairs = [a + b for a in DIGITS for b in DIGITS]
    return {
        "email": ["@"], "url": ["://"], "phone": ["+" + d for d in DIGITS],
        "ip": [f"{a}.{b}" for a, b in pairs], "card": [a + gap + b for a, b in pairs for gap in ("", " ", "-")],
        "account": cases("account") + cases("acct"), "iban": cases("iban")}


class Finder:
    def __init__(self):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for kind, words in anchors().items():
            for word in words:
                # an ip is read from the digit in front of the dot, all others from the anchor's first character
                self.automaton.add_word(word, (kind, len(word) - 1))
        self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) of all that is found, by kind and then by place; end exclusive, in code points."""
        done = dict.fromkeys(KINDS, 0)
        found: dict[str, list[tuple[str, int, int]]] = {k: [] for k in KINDS}
        for end, (kind, back) in self.automaton.iter(text):
            got = _PARSERS[kind](text, end - back, done[kind])
            if got:
                done[kind] = got[1]
                if got[2]:
                    found[kind].append((kind, got[0], got[1]))
        return [x for k in KINDS for x in found[k]]


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                     T.StructField("end", T.LongType()), T.StructField("value", T.StringType())])
FOUND = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("spans", T.ArrayType(SPAN))])


def find_personal(docs: DataFrame) -> DataFrame:
    """doc_id and `spans` (kind, start, end, value) of every row of `docs`, whole texts, by kind and place.

    Kinds: `email`; `ip` (four parts up to 255); `card` (16 to 19 digits, Luhn); `phone` (a plus and 8 to 15
    digits); `account` (6 to 17 digits that a word announces); `iban` (announced, check digits right); `url` (an
    address that carries a user). Places count code points, the end is exclusive. Kinds are searched apart, so
    spans of two kinds may overlap. Null or empty text has no spans. Rows are searched one by one: repeated rows
    come out alike, a null id stays null, an empty table stays empty, other columns are not read. Time grows
    with a text's length alone; a task holds one batch of rows.
    """
    arrow = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(pa.struct([
        ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        for batch in batches:
            spans = []
            for x in batch.column(1):
                text = x.as_py()
                spans.append([{"kind": k, "start": a, "end": b, "value": text[a:b]} for k, a, b in finder.find(text)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, arrow.field("spans").type)], schema=arrow)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_column(docs).alias("text")).mapInArrow(run, FOUND)


def count_of(kind: str) -> Column:
    """How many spans of a kind a row of find_personal has."""
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def listed(kinds=KINDS) -> Column:
    """kind:start:end of the spans of these kinds, comma-joined."""
    return F.array_join(F.transform(F.filter("spans", lambda s: s["kind"].isin(*kinds)),
                                    lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

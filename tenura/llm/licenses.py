"""License scan: short notices found with a bounded number of errors.

A notice that may differ by k characters is cut into k + 1 pieces: a match with at most k errors holds one of
them unchanged. An automaton finds all pieces of all notices in one pass, and only around those places the
regex library's bounded-error matching decides, counts the edits and gives the span.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tenura.llm.common import text_column


@dataclass(frozen=True)
class Notice:
    label: str
    words: str  # lower-case words joined by single spaces
    errors: int
    base: bool = False  # unchanged places count as the base search does


#: The base phrases with their labels, then the notices this scan adds.
NOTICES = (
    Notice("mit", "mit license", 1, base=True),
    Notice("apache", "apache license", 1, base=True),
    Notice("gpl", "general public license", 2, base=True),
    Notice("mit", "released under the mit license", 3),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 6),
    Notice("apache", "licensed under the apache license version 2 0", 4),
    Notice("gpl", "licensed under the gnu general public license version 3", 5),
    Notice("cc-by-nc", "licensed under cc by nc 4 0", 2),
    Notice("cc-by-sa", "creative commons attribution sharealike", 3),
    Notice("bsd", "redistribution and use in source and binary forms", 4),
    Notice("mpl", "mozilla public license", 2),
    Notice("all-rights-reserved", "all rights reserved", 1),
)

#: Byte to byte: A-Z to a-z; digits, letters and everything beyond ASCII stay; the rest separates words.
_CANON = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def pieces(words: str, errors: int) -> list[tuple[int, str]]:
    """errors + 1 pieces of nearly equal length with their offsets."""
    n, k = len(words), errors + 1
    cuts = [n * i // k for i in range(k + 1)]
    return [(a, words[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    def __init__(self, notices=NOTICES):
        import ahocorasick
        import regex

        self.notices = notices
        # for as many words as the notice has; no edit puts a space in, so edits lie inside words
        self.patterns = [regex.compile(f"(?b)(?:{n.words}){{e<={n.errors}:[^ ]}}") for n in notices]
        found: dict[str, list[tuple[int, int]]] = {}
        for k, n in enumerate(notices):
            for offset, piece in pieces(n.words, n.errors):
                found.setdefault(piece, []).append((k, offset))
        self.seeds = ahocorasick.Automaton()
        for piece, uses in found.items():
            self.seeds.add_word(piece, (len(piece), uses))
        self.seeds.make_automaton()

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """For each notice the stretches of text, whole words, in which a match can lie, merged where they overlap."""
        out: dict[int, list[list[int]]] = {}
        for end, (size, uses) in self.seeds.iter(text):
            for k, offset in uses:
                n = self.notices[k]
                start = end + 1 - size - offset
                held = out.setdefault(k, [])
                a, b = max(0, start - n.errors), min(len(text), start + len(n.words) + n.errors)
                if held and b <= held[-1][1] and a >= held[-1][0]:
                    continue
                a, b = text.rfind(" ", 0, a + 1) + 1, text.find(" ", b)
                b = len(text) if b < 0 else b
                while held and a <= held[-1][1]:
                    c, d = held.pop()
                    a, b = min(a, c), max(b, d)
                held.append([a, b])
        return out

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, edits) in canonical text, from left to right.

        In each stretch the unchanged places come first (pieces of them are seeds, so none is missed), and
        the fuzzy search covers what lies between them.
        """
        out = []
        for k, held in self.windows(text).items():
            words = self.notices[k].words
            for a, b in held:
                at, exact = text.find(words, a, b), []
                while at >= 0:
                    if (at == 0 or text[at - 1] == " ") and (at + len(words) == len(text) or text[at + len(words)] == " "):
                        exact.append(at)
                    at = text.find(words, at + 1, b)
                out += [(k, at, at + len(words), 0) for at in exact]
                edges = [a, *[x for at in exact for x in (at, at + len(words))], b]
                for lo, hi in zip(edges[::2], edges[1::2]):
                    out += [(k, m.start(), m.end(), sum(m.fuzzy_counts)) for m in self.near(k, text, lo, hi)]
        return sorted(out, key=lambda m: (m[1], m[0], m[2]))

    def near(self, k: int, text: str, lo: int, hi: int) -> Iterator:
        """Matches with errors of a notice inside text[lo:hi], from left to right, none over another."""
        n = self.notices[k]
        edges = [lo]
        while edges[-1] < hi:
            edges.append(text.find(" ", edges[-1] + 1, hi) if edges[-1] + 1 < hi else hi)
            edges[-1] = hi if edges[-1] < 0 else edges[-1]
        n_words, i = n.words.count(" ") + 1, 0
        while i + n_words < len(edges):
            start, end = edges[i] + (text[edges[i]] == " "), edges[i + n_words]
            m = self.patterns[k].fullmatch(text, start, end) if abs(end - start - len(n.words)) <= n.errors else None
            if m:
                yield m
            i += n_words if m else 1

    def scan(self, text: str) -> tuple:
        words = text.encode("utf-8", "surrogatepass").translate(_CANON).split()
        canon = b" ".join(words).decode("utf-8", "surrogatepass")
        spans, base = [], []
        word = at = 0
        for k, start, end, edits in self.matches(canon):
            n = self.notices[k]
            word, at = word + canon.count(" ", at, start), start
            last = word + canon.count(" ", start, end)
            spans.append({"label": n.label, "notice": n.words, "first_word": word, "last_word": last, "edits": edits,
                          "matched": canon[start:end]})
            if n.base and edits == 0 and (start == 0 or canon[start - 1] == " ") and (end == len(canon) or canon[end] == " "):
                base.append((word, n.label))
        score = max((1 - s["edits"] / len(s["notice"]) for s in spans), default=0.0)
        return (len(words), len(base), min((w for w, _ in base), default=None), max((w for w, _ in base), default=None),
                ",".join(sorted({x for _, x in base})), ",".join(sorted({s["label"] for s in spans})), score, spans)


SPAN = T.StructType([
    T.StructField("label", T.StringType()), T.StructField("notice", T.StringType()), T.StructField("first_word", T.LongType()),
    T.StructField("last_word", T.LongType()), T.StructField("edits", T.IntegerType()), T.StructField("matched", T.StringType())])
SCANNED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()), T.StructField("base_labels", T.StringType()),
    T.StructField("labels", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(SPAN))])


def scan_licenses(docs: DataFrame, notices=NOTICES) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    Texts are scanned whole, as lower-case words joined by single spaces; word positions start at 0. Base
    fields count places where the words of a base notice stand unchanged and consecutively. `labels` also has
    the notices found with errors, `spans` all of them with their edits; of overlapping matches of one notice
    the regex library's choice is reported. A match with errors consists of whole words, as many as the notice
    has; its edits lie inside them. `score` is the best 1 - edits / length, 0 without a match. Null
    text is empty: no words, null positions, empty labels. Rows are scanned one by one, so repeated rows, null
    ids and further columns change nothing.
    """
    arrow = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
        ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
        ("spans", pa.list_(pa.struct([("label", pa.string()), ("notice", pa.string()), ("first_word", pa.int64()),
                                      ("last_word", pa.int64()), ("edits", pa.int32()), ("matched", pa.string())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices)
        for batch in batches:
            rows = [scanner.scan(x.as_py()) for x in batch.column(1)]
            if rows:
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), list(arrow)[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema=arrow)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_column(docs).alias("text")).mapInArrow(run, SCANNED)

"""SentencePiece BPE encoding by a table of the last token of every prefix, and decoding.

For the merges of a BPE model the encoding of a prefix is unique, so each prefix has one last token. A token
that ends at a position (found by an automaton over all pieces) is that last token exactly if it encodes to
itself and is compatible with the last token of the prefix before it: side by side the two stay as they are.
Filling the table takes one pass; the ids are read off from its end.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tenura.llm.common import Recent, text_column

SPACE = "▁"


class PieceTable:
    """Encoder of one model. Rank: minus the score, smaller merges first; equal ranks merge from the left."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        self.library = lib = SentencePieceProcessor(model_file=path)
        self.piece, self.rank, self.ids = {}, {}, {}
        self.byte = {}
        self.automaton = ahocorasick.Automaton()
        for i in range(lib.get_piece_size()):
            text = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.byte[int(text[3:5], 16)] = i
            elif not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)):
                self.piece[i], self.rank[i], self.ids[text] = text, -lib.get_score(i), i
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        for i, text in self.piece.items():
            if self.arising(i):  # no text is encoded with the others
                self.automaton.add_word(text, (i, len(text)))
        self.automaton.make_automaton()

    def merged(self, text: str) -> tuple[list[int], tuple[int, int] | None]:
        """Merge pair by pair, best rank first, leftmost at equal ranks. Also returns the last merge. For
        texts of a few characters that consist of known ones."""
        run = [self.ids[c] for c in text]
        last = None
        while True:
            best = None
            for k in range(len(run) - 1):
                m = self.ids.get(self.piece[run[k]] + self.piece[run[k + 1]])
                if m is not None and (best is None or self.rank[m] < best[0]):
                    best = (self.rank[m], k, m)
            if best is None:
                return run, last
            k = best[1]
            last = (run[k], run[k + 1])
            run[k:k + 2] = [best[2]]

    def halves(self, i: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes token i; None for a single character or if i never arises."""
        if i not in self.parts:
            text = self.piece[i]
            known = len(text) > 1 and all(c in self.ids for c in text)
            run, last = self.merged(text) if known else ([i], None)
            self.parts[i] = last if run == [i] else None
        return self.parts[i]

    def arising(self, i: int) -> bool:
        return len(self.piece[i]) == 1 or self.halves(i) is not None

    def compatible(self, a: int, b: int) -> bool:
        """Whether the encoding of both texts together is a, b. Both arise on their own.

        Undo merges from the last one backwards. At each step the inner neighbours of the border existed
        together until the merge just undone; had their own merge come first, the border would be gone.
        """
        key = (a, b)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= 1_500_000:  # a bound on memory; far more than the pairs that are common
                self.pairs.clear()
            known = self.pairs[key] = self._stay(a, b)
        return known

    def _stay(self, a: int, b: int) -> bool:
        text_a, text_b = self.piece[a], self.piece[b]
        if SPACE + SPACE in text_a or SPACE + SPACE in text_b:  # these have one rank for all lengths
            return self.merged(text_a + text_b)[0] == [a, b]
        until, from_right = float("inf"), False
        while True:
            m = self.ids.get(self.piece[a] + self.piece[b])
            if m is not None and (self.rank[m] < until or from_right and self.rank[m] == until):
                return False
            left, right = self.halves(a), self.halves(b)
            if left is None and right is None:
                return True
            if right is None or left is not None and self.rank[a] > self.rank[b]:
                until, from_right, a = self.rank[a], False, left[1]
            else:
                until, from_right, b = self.rank[b], True, right[0]

    def encode(self, text: str) -> list[int]:
        """Ids of a text whose spaces are already written as the space mark."""
        n = len(text)
        last: list[int] = [-1] * (n + 1)  # -1: nothing ends here, so a character without a piece, or the start
        length = [1] * (n + 1)
        pairs = self.pairs
        for end, (token, size) in self.automaton.iter(text):
            end += 1
            if last[end] >= 0:
                continue
            before = last[end - size]
            if before >= 0:
                stay = pairs.get((before, token))
                if not (self.compatible(before, token) if stay is None else stay):
                    continue
            last[end], length[end] = token, size
        ids, at = [], n
        while at:
            if last[at] >= 0:
                ids.append(last[at])
                at -= length[at]
            else:
                ids.extend(self.byte[x] for x in reversed(text[at - 1].encode()))
                at -= 1
        ids.reverse()
        return ids


class Encoder:
    """Decimal ids of texts. No piece holds a space mark after another character or a line feed, so runs (a word with
    the space before it) are encoded apart, and what was seen lately is not encoded again."""

    def __init__(self, path: str):
        self.table = PieceTable(path)
        pieces = self.table.ids
        joined = {b for p in pieces for a, b in zip(p, p[1:]) if a.isalpha()}
        self.marks = "".join(c for c in ".,;:!?" if c in pieces and c not in joined)
        self.word = Recent(lambda run: self.made(SPACE + run, self.word, run), 1_200_000)
        self.bare = Recent(lambda run: self.made(run, self.bare, run))
        apart = all(SPACE not in p.lstrip(SPACE) and "\n" not in p for p in pieces)
        self.split = apart and SPACE in pieces

    def made(self, text: str, known: Recent, run: str) -> bytes:
        if len(run) > 1 and run[-1] in self.marks and run[-2].isalpha():
            return known[run[:-1]] + self.bare[run[-1]]  # no piece holds a letter with this mark after it
        return b"".join(b",%d" % i for i in self.table.encode(text))

    def ids_text(self, text: str) -> bytes:
        """Ids of a text as decimals, a comma before each. Empty text has none."""
        if not text:
            return b""
        if not self.split or SPACE in text:
            return b"".join(b",%d" % i for i in self.table.encode(SPACE + text.replace(" ", SPACE)))
        if "  " in text or text[0] == " ":
            return b"".join(self.loose(" " + text))
        out = []
        word = self.word.__getitem__
        for k, line in enumerate(text.split("\n")):
            words = line.split(" ")
            if k:
                out.append(self.bare["\n"])
                out.append(self.bare[words[0]])
            else:
                out.append(word(words[0]))
            out.extend(map(word, words[1:]))
        return b"".join(out)

    def loose(self, text: str) -> Iterator[bytes]:
        """The same for text with runs of spaces: a run belongs to the word after it."""
        import re

        for run in re.findall(r" *[^ \n]+| +|\n", text):
            yield self.bare[run.replace(" ", SPACE)]


_encoders: dict[str, Encoder] = {}
ROWS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
])
ENCODED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])


def _encoder(path: str) -> Encoder:
    return _encoders.get(path) or _encoders.setdefault(path, Encoder(path))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_column(docs).alias("text"))


def _as_ids(found: bytes) -> list[int]:
    return list(map(int, found[1:].split(b","))) if found else []


def encode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids) of every whole text, without begin and end ids; null or empty text has no ids. Rows
    are encoded one by one, so repeated rows, null ids and further columns need no rule of their own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model)
        for batch in batches:
            ids = [_as_ids(encoder.ids_text(x.as_py())) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])
    return _texts(docs).mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids) by the library; null ids decode to an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = _encoder(model).table.library
        for batch in batches:
            texts = [lib.decode(x.as_py() or []) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text: encoded by the prefix table, then
    decoded by the library, in one pass that holds one text's ids at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model)
        decode_ids = encoder.table.library.decode
        schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                            ("decoded_sha256", pa.string())])
        for batch in batches:
            n, ids_hex, text_hex = [], [], []
            for x in batch.column(1):
                found = encoder.ids_text(x.as_py())
                n.append(found.count(b","))
                ids_hex.append(hashlib.sha256(found[1:]).hexdigest())
                text_hex.append(hashlib.sha256(decode_ids(_as_ids(found)).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(text_hex, pa.string())],
                schema=schema)
    return _texts(docs).mapInArrow(run, ROWS)

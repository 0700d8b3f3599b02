"""Fill-in-middle: texts rotated so that a model sees the prefix and the suffix before the middle.

A text is cut between lines, sentinels are inserted in one bytearray in front of the prefix, the middle and the
suffix, and two neighbouring blocks change places by three reversals inside the buffer. The way back exchanges
the same blocks again and takes the sentinels out.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tenura.llm.common import text_column

#: The marks in front of prefix, middle and suffix.
PREFIX, MIDDLE, SUFFIX = b"<P>", b"<M>", b"<S>"
#: Bytes exchanged at a time by a reversal, and output bytes gathered before a batch is handed on.
STEP, BATCH_BYTES = 1 << 16, 1 << 24


@dataclass(frozen=True)
class Rates:
    """Which documents are rotated (percent), and how many of them with the suffix first (percent)."""
    seed: int = 7
    rotated: int = 100
    suffix_first: int = 50


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers below 2^32 that depend on the document id alone; a null id counts as no digits."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[k:k + 4], "big") for k in (0, 4, 8, 12)]


def reverse(view: np.ndarray, a: int, b: int) -> None:
    """Turn view[a:b] round in place, from both ends to the centre, STEP bytes at a time."""
    while b - a > 1:
        n = min(STEP, (b - a) // 2)
        head = view[a:a + n].copy()
        view[a:a + n] = view[b - n:b][::-1]
        view[b - n:b] = head[::-1]
        a, b = a + n, b - n


def exchange(buffer: bytearray, a: int, b: int, c: int) -> None:
    """Let buffer[a:b] and buffer[b:c] change places by three reversals."""
    view = np.frombuffer(buffer, np.uint8)
    reverse(view, a, b)
    reverse(view, b, c)
    reverse(view, a, c)


def line_ends(text: bytes) -> np.ndarray:
    """Where the lines end: after each line feed, and at the end of a text that ends without one."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return ends if not text or text[-1] == 10 else np.append(ends, len(text))


def characters(text: bytes, a: int, b: int) -> int:
    """Code points in text[a:b]: bytes that do not continue one."""
    return int(np.count_nonzero(np.frombuffer(text, np.uint8)[a:b] & 0xC0 != 0x80))


def rotate(text: bytes, doc_id: int | None, rates: Rates) -> tuple[int, str, int | None, int | None, bytes]:
    """(lines, form, prefix_chars, middle_chars, output) of one text in UTF-8."""
    ends = line_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = draws(rates.seed, doc_id)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= rates.rotated:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    one, two = (int(ends[k - 1]) if k else 0 for k in (low, high))
    buffer = bytearray(text)
    for at, mark in ((two, SUFFIX), (one, MIDDLE), (0, PREFIX)):
        buffer[at:at] = mark
    middle, suffix, end = one + len(PREFIX), two + len(PREFIX) + len(MIDDLE), len(buffer)
    form = "spm" if h4 % 100 < rates.suffix_first else "psm"
    exchange(buffer, 0 if form == "spm" else middle, suffix, end)
    return n, form, characters(text, 0, one), characters(text, one, two), bytes(buffer)


def restore(output: bytes, form: str) -> bytes:
    """The exact text of an output: the blocks change places again, then the sentinels go.

    A sentinel is where it is found first: rotated texts hold none, and none can arise at a seam, because `<`
    and `>` stand only at the ends of one.
    """
    if form == "plain":
        return output
    buffer = bytearray(output)
    if form == "psm":
        prefix, suffix, middle = 0, buffer.index(SUFFIX), buffer.index(MIDDLE)
        exchange(buffer, suffix, middle, len(buffer))
        middle, suffix = suffix, suffix + len(buffer) - middle
    elif form == "spm":
        suffix, prefix, middle = 0, buffer.index(PREFIX), buffer.index(MIDDLE)
        exchange(buffer, 0, prefix, len(buffer))
        middle, suffix, prefix = middle - prefix, len(buffer) - prefix, 0
    else:
        raise ValueError(f"not a form: {form!r}")
    for at, mark in ((suffix, SUFFIX), (middle, MIDDLE), (prefix, PREFIX)):
        if buffer[at:at + len(mark)] != mark:
            raise ValueError("not an output of this form")
        del buffer[at:at + len(mark)]
    return bytes(buffer)


ROTATED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
    T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())])
RESTORED = T.StructType([*ROTATED.fields, T.StructField("restored", T.StringType())])


def _arrow(schema: T.StructType) -> pa.Schema:
    return pa.schema([(f.name, pa.int64() if f.dataType == T.LongType() else pa.string()) for f in schema.fields])


def _handed_on(rows: Iterator[tuple], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    """Batches of the rows, each closed once its last columns (bytes in UTF-8) are BATCH_BYTES long."""
    arrow, held, size = _arrow(schema), [], 0

    def batch() -> pa.RecordBatch:
        columns = [pa.array(c, pa.binary()).cast(f.type) if f.name in ("output", "restored") else pa.array(c, f.type)
                   for c, f in zip(zip(*held), arrow)]
        return pa.RecordBatch.from_arrays(columns, schema=arrow)

    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row[5:])
        if size >= BATCH_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _bytes(column: pa.Array) -> Iterator[bytes]:
    return (x.as_py() for x in column.cast(pa.binary()))


def fill_in_middle(docs: DataFrame, rates: Rates = Rates()) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output for every row of `docs`, text by text.

    A text is `n` lines, each with its line feed. The prefix ends after the smaller, the middle after the larger
    of two line numbers that depend on the id alone; either may be empty. `plain` texts stay as they are: empty
    and null ones, those that hold a sentinel, and the share that `rates` leaves out. `psm` is prefix, suffix,
    middle; `spm` is suffix, prefix, middle, each after its sentinel. Lengths are in code points, null if plain.

    A null id draws as the empty string does. Repeated rows come out alike, an empty table empty; other columns
    are not read. A task holds one incoming batch, one buffer and BATCH_BYTES of output beyond the last text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((d, *rotate(t, d, rates)) for b in batches for d, t in zip(b.column(0).to_pylist(), _bytes(b.column(1))))
        return _handed_on(rows, ROTATED)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_column(docs).alias("text")).mapInArrow(run, ROTATED)


def restored(rotated: DataFrame) -> DataFrame:
    """The rows of fill_in_middle with `restored`: the text rebuilt from output and form alone. An output that
    is not of its form is an error."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((*row, out, restore(out, row[2])) for b in batches
                for *row, out in zip(*(c.to_pylist() for c in b.columns[:5]), _bytes(b.column(5))))
        return _handed_on(rows, RESTORED)

    return rotated.select(*ROTATED.fieldNames()).mapInArrow(run, RESTORED)

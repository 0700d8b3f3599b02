"""Sequence packing by minimum bin slack over remaining lengths.

Documents become token ids, are cut at multiples of the window, and what is left over is packed: a bitset
subset-sum table over the multiset of lengths finds the fill closest to a window, backtracking tells how
many pieces of each length it takes, and the same fill is repeated as often as the counts allow.
"""

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.llm.common import Recent, text_column, worker_table
from tenura.session import written_table

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
])


class WordIds(Recent):
    """Token ids (little-endian unsigned 32-bit) of a run of characters without space, tab or line feed.

    The tokenizer never joins across white space, so the ids of a text are those of its runs in order. Runs repeat a
    lot: those seen lately are not encoded again. A run that ends in a mark is made of two others, so it is held
    from its second time on only; `met` has a mark by hash for those met once, and is emptied when a quarter is marked.
    """

    def __init__(self, path: str, room: int = 400_000):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__(self.alone, room)
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces = self.tokenizer.model.tokenize
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.as_bytes = {c: "".join(x for x, _ in level.pre_tokenize_str(chr(c))) for c in range(128, 256) if chr(c).isalpha()}
        self.met, self.marked = bytearray(1 << 20), 0

    def alone(self, run: str) -> bytes:
        if _mark_after_letter(run):
            return self[run[:-1]] + self[run[-1]]
        if run.isalpha() and run.islower() and (run.isascii() or max(run) < "\u0100"):
            # one word to the tokenizer, and nothing in it to normalise: its model alone says the ids
            ids = [t.id for t in self.pieces(run if run.isascii() else run.translate(self.as_bytes))]
        else:
            ids = self.tokenizer.encode(run, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def hold(self, key: str, value: bytes) -> None:
        if _mark_after_letter(key):
            at = hash(key) & (len(self.met) - 1)
            if not self.met[at]:
                if self.marked >= len(self.met) // 4:
                    self.met, self.marked = bytearray(len(self.met)), 0
                self.met[at] = 1
                self.marked += 1
                return
        super().hold(key, value)

    def of(self, text: str) -> bytes:
        try:
            text.encode("latin-1")
            lower = text.lower()  # what the tokenizer does; beyond Latin-1 its rules may differ from Python's
            if not any(t in lower for t in self.added):  # added tokens are matched before, in their own case only
                text = lower
        except UnicodeEncodeError:
            pass
        return b"".join(map(self.__getitem__, text.replace("\n", " ").replace("\t", " ").split(" ")))


def _mark_after_letter(run: str) -> bool:
    """Whether the last character is a mark that is a word of its own."""
    return len(run) > 1 and run[-1] in ",." and "a" <= run[-2] <= "z"


def _cut(path: str, window: int, end_id: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = worker_table((WordIds, path), lambda: WordIds(path))
    end = np.asarray([end_id], "<u4").tobytes()
    schema = pa.schema([(f.name, pa.int64()) for f in PIECES.fields])
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids = words.of(text.as_py()) + end
            n = len(ids) // 4
            for s in range(0, n, window):
                piece = ids[4 * s:4 * (s + window)]
                rows.append((doc_id, s, len(piece) // 4, zlib.crc32(piece), n))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)


def cut_documents(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens): every document's ids and then `end_id`, cut
    at multiples of `window`. Null text is empty and has the end id alone."""
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_column(docs).alias("text"))
    return texts.mapInArrow(lambda batches: _cut(tokenizer, window, end_id, batches), PIECES)


def padding(total: int, window: int) -> int:
    """Ids added to a sequence: up to the window, none at a power of two."""
    return 0 if total & (total - 1) == 0 else window - total


def best_fill(counts: dict[int, int], window: int) -> dict[int, int]:
    """The multiset, at most `counts` of each length, that holds the longest length and leaves least padding.

    One big-integer bitset per item has bit s set when sum s can be reached. A length that may be used up
    to m times enters as 1, 2, 4, ... copies. Walking back through the bitsets gives the counts.
    """
    longest = max(counts)
    room = window - longest
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        most = min(counts[length] - (length == longest), room // length)
        copies = 1
        while most > 0:
            take = min(copies, most)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            most -= take
            copies *= 2
        if reach >> room & 1:
            break
    ends = [reach.bit_length() - 1]
    ends += [p - longest for p in (1 << b for b in range(window.bit_length())) if 0 <= p - longest <= room
             and reach >> (p - longest) & 1]
    total = longest + min(ends, key=lambda s: (padding(longest + s, window), -s))
    used, left = {longest: 1}, total - longest
    for length, take, before in reversed(steps):
        if not before >> left & 1:
            used[length] = used.get(length, 0) + take
            left -= length * take
    return used


def plan_windows(counts: dict[int, int], window: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first_rank, last_rank, uses, first_sequence, offset) that seat every piece.

    Pieces of one length are numbered from 0. A fill that repeats r times takes `uses` pieces of a length
    in each of r sequences. Each fill exhausts a length or leaves fewer pieces of it than one fill uses, so
    their number depends on the window alone, not on how many documents there are.
    """
    counts = {k: v for k, v in counts.items() if v > 0}
    seated = dict.fromkeys(counts, 0)
    plan, sequence = [], 0
    while counts:
        used = best_fill(counts, window)
        times = min(counts[k] // n for k, n in used.items())
        offset = 0
        for length in sorted(used, reverse=True):
            n = used[length]
            plan.append((length, seated[length], seated[length] + n * times - 1, n, sequence, offset))
            seated[length] += n * times
            offset += length * n
            counts[length] -= n * times
            if not counts[length]:
                del counts[length]
        sequence += times
    return plan


PLAN = "length long, first_rank long, last_rank long, uses long, first_sequence long, first_offset long"


def pack(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1, buckets: int = 64) -> DataFrame:
    """Pieces with their place: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id of every document is in one piece, no sequence is longer than `window`, offsets are gapless
    from 0. Null text counts as empty (the end id alone); repeated rows are packed as often as they occur;
    a null doc_id stays null; an empty table gives an empty result. Other columns are not read.

    Only the counts of each length reach the driver (at most `window` rows). Ranks inside a length are
    taken in `buckets` hash buckets with offsets between them, so a length that most documents share is
    spread over tasks.
    """
    spark = docs.sparkSession
    spread = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)).cast("int")
    pieces = written_table(spark, cut_documents(docs, tokenizer, window, end_id).withColumn("bucket", spread))
    sizes = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.createDataFrame(plan_windows(counts, window), PLAN)
    before = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(
        _window("length", "bucket").rowsBetween(-(1 << 31), -1)), F.lit(0)).alias("before"))
    ranked = pieces.select("*", F.row_number().over(
        _window(["length", "bucket"], "doc_id", "start", "ids_crc32")).alias("nth"))
    ranked = ranked.join(before, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("nth") - 1)
    seat = F.col("rank") - F.col("first_rank")
    return (
        ranked.join(F.broadcast(plan), (ranked["length"] == plan["length"])
                    & ranked["rank"].between(plan["first_rank"], plan["last_rank"]))
        .select("doc_id", "start", ranked["length"], "ids_crc32", "doc_tokens",
                (F.col("first_sequence") + F.floor(seat / F.col("uses"))).cast("long").alias("sequence_id"),
                (F.col("first_offset") + F.pmod(seat, F.col("uses")) * ranked["length"]).cast("long").alias("offset"))
    )


def _window(by, *order):
    from pyspark.sql import Window

    return Window.partitionBy(by).orderBy(*order)

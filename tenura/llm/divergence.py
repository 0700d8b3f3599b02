"""Source divergence audit by chunk factorization.

How differently do the sources of one language use its words? Texts are split at white space and their chunks are
counted in the documents that hold them; each chunk of a language is taken apart into terms once; the terms
are joined back to the counts and give distinct documents and occurrences. Shares of terms are whole numbers, so
every result is exact.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.llm.common import by_task, text_column
from tenura.llm.forest import _sieve
from tenura.llm.lines import LOWER, UPPER
from tenura.session import written_table

#: Characters of a term: ASCII letters and everything beyond ASCII.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Longer chunks are cut at everything that is no part of a term, too.
LONG = 256
_LONG_RUN = re.compile(r"[^\t-\r ]{%d,}" % (LONG + 1))
_NO_TERM = re.compile(r"[\x00-\x40\x5B-\x60\x7B-\x7F]+")


@dataclass(frozen=True)
class Sizes:
    """How much one task holds at a time; results do not depend on it."""
    text_bytes: int = 1 << 25  # of texts whose chunks are counted together
    rows: int = 10_000         # of them; a row's number among them fits into a short
    terms: int = 4096          # compared together
    sources: int = 64          # on each side of a comparison


POSTINGS = ("lang string, chunk string, part_of long, docs array<smallint>, sources array<string>, ns array<long>")
_ARROW = pa.schema([("lang", pa.string()), ("chunk", pa.string()), ("part_of", pa.int64()), ("docs", pa.list_(pa.int16())),
                    ("sources", pa.list_(pa.string())), ("ns", pa.list_(pa.int64()))])


def _split(texts: pa.Array) -> pa.ListArray:
    words = pc.ascii_split_whitespace(texts)
    longest = pc.max(pc.binary_length(words.flatten())).as_py() or 0
    if longest > LONG:
        cut = [_LONG_RUN.sub(lambda m: _NO_TERM.sub(" ", m[0]), x) for x in texts.to_pylist()]
        words = pc.ascii_split_whitespace(pa.array(cut, pa.string()))
    return words


def _lists(starts: np.ndarray, n: int, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, n), pa.int32()), values)


def count_chunks(batch: pa.RecordBatch, part_of: int) -> pa.RecordBatch:
    """One row per (lang, chunk) of these documents: the documents that hold it, and how often each source does."""
    words = _split(batch.column("text"))
    coded = words.flatten().dictionary_encode()
    doc, chunk = pc.list_parent_indices(words).to_numpy(), coded.indices.to_numpy()
    real = np.array(pc.not_equal(coded.dictionary, ""), bool)[chunk] if len(chunk) else np.zeros(0, bool)
    doc, chunk = doc[real], chunk[real]
    langs, sources = batch.column("lang").dictionary_encode(), batch.column("source").dictionary_encode()
    n_docs, n_chunks, n_sources = batch.num_rows, max(len(coded.dictionary), 1), max(len(sources.dictionary), 1)
    group = langs.indices.to_numpy().astype(np.int64)[doc] * n_chunks + chunk
    held, times = np.unique(group * n_docs + doc, return_counts=True)
    group, doc = held // n_docs, held % n_docs
    keys, starts = np.unique(group, return_index=True)
    by_source, place = np.unique(group * n_sources + sources.indices.to_numpy()[doc], return_inverse=True)
    ns = np.zeros(len(by_source), np.int64)
    np.add.at(ns, place, times)
    source_starts = np.searchsorted(by_source, keys * n_sources)
    return pa.RecordBatch.from_arrays([
        langs.dictionary.take(pa.array(keys // n_chunks)), coded.dictionary.take(pa.array(keys % n_chunks)),
        pa.array(np.full(len(keys), part_of)), _lists(starts, len(doc), pa.array(doc.astype(np.int16))),
        _lists(source_starts, len(ns), sources.dictionary.take(pa.array(by_source % n_sources))),
        _lists(source_starts, len(ns), pa.array(ns))], schema=_ARROW)


def _parts(batch: pa.RecordBatch, sizes: Sizes) -> Iterator[pa.RecordBatch]:
    """The batch in parts of bounded rows and text, or of one row."""
    size = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = size[start - 1] if start else 0
        stop = max(start + 1, min(start + sizes.rows, int(np.searchsorted(size, before + sizes.text_bytes, "right"))))
        yield batch.slice(start, stop - start)
        start = stop


def postings(docs: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """(lang, chunk, part_of, docs, sources, ns): chunks counted in the documents of one part of a task.

    `docs` are row numbers inside the part, `sources` with `ns` the occurrences by source. Every row of `docs`
    is a document of its own. A chunk that is in every document has one row for each part, not for each document.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part_of = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in _parts(batch, sizes):
                yield count_chunks(part, part_of)
                part_of += 1

    named = [F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    return docs.select(*named, text_column(docs).alias("text")).mapInArrow(run, POSTINGS)


def terms_of(chunk: Column) -> Column:
    """Terms of a chunk in order, repeats included; only A-Z are lower-cased."""
    return F.regexp_extract_all(F.translate(chunk, UPPER, LOWER), F.lit(TERM), F.lit(0))


def _among(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Postings whose chunk is probably among the wanted ones, by a bitmap of bounded size; a join decides."""
    def key(df):
        return df.withColumn("key", F.xxhash64("lang", "chunk"))
    return _sieve(key(rows), "key", key(wanted).select("key")).drop("key")


def term_counts(docs: DataFrame, min_docs: int = 30, sizes: Sizes = Sizes()) -> DataFrame:
    """(lang, source, term, n): occurrences of the terms that at least `min_docs` documents of the language hold.

    The documents of a term are at least those of one of its chunks and at most those of all its chunks added up.
    Where one of these bounds decides, the documents need not be united; for the other terms they are, part by part,
    because a document may hold a term in several chunks.
    """
    spark = docs.sparkSession
    counted = written_table(spark, postings(docs, sizes))
    held = written_table(spark, counted.groupBy("lang", "chunk").agg(F.sum(F.size("docs")).alias("held")))
    apart = held.select("lang", "chunk", "held", terms_of(F.col("chunk")).alias("terms"))
    times = F.when(F.size("terms") == 1, 1).otherwise(F.size(F.filter("terms", lambda t: t == F.col("term"))))
    term_of = written_table(spark, (
        apart.select("lang", "chunk", "held", "terms", F.explode(F.array_distinct("terms")).alias("term"))
        .select("lang", "chunk", "held", "term", times.alias("times"))))
    bounds = written_table(spark, (
        term_of.groupBy("lang", "term").agg(F.max("held").alias("at_least"), F.sum("held").alias("at_most"))
        .where(F.col("at_most") >= min_docs)))

    open_terms = bounds.where(F.col("at_least") < min_docs).select("lang", "term")
    open_chunks = written_table(spark, term_of.join(open_terms, ["lang", "term"], "left_semi").select("lang", "chunk", "term"))
    united = (
        _among(counted.select("lang", "chunk", "part_of", "docs"), open_chunks).join(open_chunks, ["lang", "chunk"])
        .groupBy("lang", "term", "part_of").agg(F.size(F.array_distinct(F.flatten(F.collect_list("docs")))).alias("n_docs"))
        .groupBy("lang", "term").agg(F.sum("n_docs").alias("n_docs")).where(F.col("n_docs") >= min_docs))
    kept = bounds.where(F.col("at_least") >= min_docs).select("lang", "term").unionByName(united.select("lang", "term"))

    wanted = written_table(spark, term_of.join(kept, ["lang", "term"], "left_semi").select("lang", "chunk", "term", "times"))
    return (
        _among(counted.select("lang", "chunk", "sources", "ns"), wanted).join(wanted, ["lang", "chunk"])
        .select("lang", "term", "times", "ns", F.posexplode("sources").alias("k", "source"))
        .groupBy("lang", "source", "term").agg(F.sum(F.get("ns", "k") * F.col("times")).alias("n")))


def share(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(10^9 (n + 5) / (total + 5 v)) in whole numbers; null where there are no terms."""
    n, total, v = (c.cast("decimal(19,0)") for c in (n, total, v))
    five, scale = F.lit(5).cast("decimal(1,0)"), F.lit(1_000_000_000).cast("decimal(10,0)")
    return 1 + F.call_function("div", scale * (n + five), F.nullif(total + five * v, F.lit(0)))


def group_totals(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, source, total, v, g) of every group of documents: its occurrences of kept terms, the language's number
    of kept terms, and the group's number in its language."""
    named = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = counts.groupBy("lang").agg(F.countDistinct("term").alias("v"))
    return (
        named.join(totals, ["lang", "source"], "left").join(sizes, ["lang"], "left")
        .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"),
                (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("g")))


CELL = ["lang", "slice", "block_i", "block_j"]
DISTANCES = "lang string, a int, b int, f long"


def _cell_distances(block: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of |p - q| over one slice of terms for the pairs of groups of one cell, each pair once."""
    for cell in by_task(CELL, batches):
        g, term, p, n_terms = (cell.column(c).combine_chunks() for c in ("g", "term", "p", "n_terms"))
        groups, row = np.unique(g.to_numpy(), return_inverse=True)
        p = p.to_numpy()
        absent = np.array(term.is_null(), bool)  # rows without a term hold a group's share of a term it lacks
        column = term.filter(pa.array(~absent)).dictionary_encode()
        shares = np.empty((len(groups), len(column.dictionary)), np.int64)
        shares[row[absent]] = p[absent][:, None]
        shares[row[~absent], column.indices.to_numpy()] = p[~absent]
        without = np.empty(len(groups), np.int64)
        without[row[absent]] = p[absent]
        elsewhere = pc.max(n_terms).as_py() - shares.shape[1]  # terms of the slice that no group of this cell has
        i, j = cell["block_i"][0].as_py(), cell["block_j"][0].as_py()
        of_i, of_j = np.flatnonzero(groups // block == i), np.flatnonzero(groups // block == j)
        out = []
        for x in of_i:
            others = of_j if i < j else of_j[of_j > x]
            apart = np.abs(shares[others] - shares[x]).sum(axis=1) + elsewhere * np.abs(without[others] - without[x])
            out.append((np.full(len(others), groups[x]), groups[others], apart))
        a, b, f = (np.concatenate(c) for c in zip(*out))
        yield pa.RecordBatch.from_arrays(
            [pa.array([cell["lang"][0].as_py()] * len(a), pa.string()), pa.array(a, pa.int32()), pa.array(b, pa.int32()),
             pa.array(f, pa.int64())], names=["lang", "a", "b", "f"])


def distances(shares: DataFrame, groups: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """(lang, a, b, f) for the groups a < b of every language: |p - q| summed over all kept terms.

    Terms are dealt to slices by hash, groups to blocks; a cell compares two blocks over one slice in a table of
    about `sizes.terms` terms by 2 `sizes.sources` groups, so no task depends on how many terms or sources a
    language has. A language without terms has one empty slice and distances of 0.
    """
    slices = F.greatest(F.ceil(F.col("v") / sizes.terms), F.lit(1)).cast("long")
    several = groups.withColumn("slices", slices).withColumn("n_blocks", F.max("g").over(Window.partitionBy("lang")) / sizes.sources)
    slice_of = F.pmod(F.xxhash64("term"), "slices").alias("slice")
    present = shares.join(several.select("lang", "source", "slices", "g", "n_blocks"), ["lang", "source"]).select(
        "lang", slice_of, "g", "n_blocks", "term", "p", F.lit(0).cast("long").alias("n_terms"))
    in_slice = present.select("lang", "slice", "term").distinct().groupBy("lang", "slice").agg(F.count("*").alias("n_terms"))
    # of each group one row in every slice: its share of a term that it lacks
    lacking = several.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"), "g", "n_blocks",
                             F.lit(None).cast("string").alias("term"), F.coalesce(share(F.lit(0), F.col("total"), F.col("v")), F.lit(0)).alias("p"))
    lacking = lacking.join(in_slice, ["lang", "slice"], "left").withColumn("n_terms", F.coalesce("n_terms", F.lit(0)))
    own, other = (F.col("g") / sizes.sources).cast("int"), F.col("other")
    cells = (
        present.unionByName(lacking)
        .select("*", F.explode(F.sequence(F.lit(0), F.col("n_blocks").cast("int"))).alias("other"))
        .select("lang", "slice", F.least(own, other).alias("block_i"), F.greatest(own, other).alias("block_j"), "g", "term", "p", "n_terms"))
    dealt = cells.repartition(*CELL).sortWithinPartitions(*CELL)
    return dealt.mapInArrow(partial(_cell_distances, sizes.sources), DISTANCES).groupBy("lang", "a", "b").agg(F.sum("f").alias("f"))


def audit(docs: DataFrame, min_docs: int = 30, top: int = 50, sizes: Sizes = Sizes()) -> DataFrame:
    """lang, source, part, item, value, rank for every group (lang, source) of `docs`.

    `pair`: each other source of the language with the distance of the two; `term`: the kept terms that the group
    uses more than its language does, the `top` largest differences. Ranks start at 1, larger values first, then
    the item in byte order.

    Every row of `docs` is a document, repeated ids and repeated rows included (a repeated row counts twice). Null
    text, lang and source are empty strings; a group without terms is compared with shares of zero counts; a
    language without kept terms has distances of 0 and no terms; ties rank by item; an empty table gives an empty
    result. Other columns are not read. Whole texts are counted; a task holds one incoming batch
    and the chunks of one part of it (`sizes`).
    """
    spark = docs.sparkSession
    counts = written_table(spark, term_counts(docs, min_docs, sizes))
    groups = written_table(spark, group_totals(docs, counts))
    shares = written_table(spark, counts.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("n"), F.col("total"), F.col("v")).alias("p")))

    languages = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("v").alias("v"))
    common = counts.groupBy("lang", "term").agg(F.sum("n").alias("n")).join(languages, "lang").select(
        "lang", "term", share(F.col("n"), F.col("total"), F.col("v")).alias("q"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = (
        shares.join(common, ["lang", "term"]).where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))

    both = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x")
    names = groups.select("lang", "g", "source")
    pairs = (
        distances(shares, groups, sizes).select("lang", "f", both)
        .join(names.withColumnRenamed("g", "ga"), ["lang"]).where("ga = x.a")
        .join(names.select("lang", F.col("g").alias("gb"), F.col("source").alias("item")), ["lang"]).where("gb = x.b")
        .select("lang", "source", F.lit("pair").alias("part"), "item", F.col("f").alias("value"))
        .withColumn("rank", F.row_number().over(order)))
    return pairs.unionByName(terms)

"""Line dedup: lines that many documents share stay only in the document with the largest id."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import text_column
from tenura.session import written_table

#: What is stripped at the ends of a line: space, tab, line feed, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """Stripped at both ends, A-Z lower-cased, everything else as it is."""
    bare = F.btrim(line, F.lit(BLANKS))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _judged(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """Every row as a struct `row`, so that no column of it can clash, with `line_dedup`; see dedup_lines.
    """
    source = docs.select(
        docs["doc_id"].alias("d"), F.xxhash64(text_column(docs)).alias("t"), F.split(text_column(docs), "\n", -1).alias("lines"))
    line = source.select("d", "t", F.posexplode("lines").alias("pos", "line"))
    line = line.where(F.octet_length("line") >= min_chars).withColumn("key", line_key(F.col("line")))
    line = line.where(F.char_length("key") >= min_chars).select(
        "d", "t", "pos", F.xxhash64("key").alias("k1"), F.xxhash64("key", F.lit(9)).alias("k2"))
    per_doc = line.groupBy("k1", "k2", "d").agg(F.lit(1).alias("one"))
    marked = (
        per_doc.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.max("d").alias("stays"))
        .where(F.col("n") >= min_docs).select("k1", "k2", "stays")
    )
    # Written, so that both sides of the next join come from a shuffle and the skew join may split a hot key.
    marked = written_table(docs.sparkSession, marked)
    gone = (
        line.join(marked, ["k1", "k2"]).where(~F.col("d").eqNullSafe(F.col("stays")))
        .groupBy(F.col("d").alias("gone_d"), F.col("t").alias("gone_t"))
        .agg(F.array_sort(F.collect_set("pos")).alias("gone_at"))
    )
    # Flags by position: one false for each line that stays before a lost one, so a lookup is by index.
    flags = F.flatten(F.transform("gone_at", lambda p, i: F.concat(
        F.array_repeat(F.lit(False), p - F.when(i > 0, F.get("gone_at", i - 1)).otherwise(F.lit(-1)) - 1),
        F.array(F.lit(True)))))
    gone = gone.select("gone_d", "gone_t", flags.alias("gone_flags"), F.size("gone_at").alias("gone_n"))

    row = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
                      docs["doc_id"].alias("d"), text_column(docs).alias("x"))
    row = row.join(gone, row["d"].eqNullSafe(gone["gone_d"]) & (F.xxhash64(row["x"]) == gone["gone_t"]), "left")
    lines = F.split("x", "\n", -1)
    stays = F.when(F.col("gone_n").isNull(), F.col("x")).otherwise(
        F.array_join(F.filter(lines, lambda _, i: ~F.coalesce(F.get("gone_flags", i), F.lit(False))), "\n"))
    return row.select("row", F.struct(
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.col("gone_n"), F.lit(0)).cast("long").alias("n_dropped"),
        stays.alias("kept")).alias("line_dedup"))


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """All rows and columns of `docs` with `line_dedup` = struct(n_lines, n_dropped, kept) added.

    A text is split at \\n; null or empty text is one empty line. Keys (`line_key`) of at least
    `min_chars` code points that at least `min_docs` documents hold lose their lines in every document
    but the one with the largest doc_id. The other lines stay in order, joined by \\n.

    Documents are told apart by doc_id. Rows that repeat a doc_id count as one document and are treated
    alike; a null doc_id is a document of its own, smaller than every other. Keys are compared by two
    64-bit hashes. Further columns pass through untouched, whatever their names.

    Plan: narrow (key, doc_id, position) rows are counted by (key, doc_id) and then by key, so a line
    that is everywhere is pre-aggregated; the marked keys join back with the skew join free to split a
    hot key; texts move at most once, to meet the positions that they lose. No Python.
    """
    return _judged(docs, min_chars, min_docs).select("row.*", "line_dedup")


def drop_shared_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """`docs` with the lost lines taken out of `text`; n_chars, where there is one, follows a changed text.
    All other columns and unchanged texts stay as they are."""
    out = _judged(docs, min_chars, min_docs)
    changed = F.col("line_dedup.n_dropped") > 0
    columns = [out["row"][c].alias(c) for c in docs.columns]
    at = docs.columns.index("text")
    columns[at] = F.when(changed, F.col("line_dedup.kept")).otherwise(out["row"]["text"]).alias("text")
    if "n_chars" in docs.columns:
        n_chars = F.char_length("line_dedup.kept").cast(docs.schema["n_chars"].dataType)
        columns[docs.columns.index("n_chars")] = F.when(changed, n_chars).otherwise(out["row"]["n_chars"]).alias("n_chars")
    return out.select(columns)

"""Corpus pipeline: toxic documents go, shared lines go, one document of each near-duplicate class stays, the
rest is packed. Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept."""

from pyspark.sql import DataFrame, SparkSession

from tenura.llm.forest import keep_one
from tenura.llm.lines import drop_shared_lines
from tenura.llm.packing import pack
from tenura.llm.queries import table, tokenizer_path
from tenura.llm.toxicity import reject_toxic, train
from tenura.session import written_table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels that are not held out, does not reject."""
    return reject_toxic(docs, train(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, texts without the lines that another document keeps; n_chars follows a changed text."""
    return drop_shared_lines(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return keep_one(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in sequences."""
    return pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("jaccard_join", jaccard_join), ("packing", packing)]

# Learning, similarity classes and tokenizer ids are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written_table(spark, stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

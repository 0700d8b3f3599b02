"""Toxicity: a logistic classifier whose score may not depend on which group a sentence mentions.

Labelled texts that mention an identity term get a twin for every other term of its row; besides the log loss,
training penalises the squared differences of their scores. Texts without such a term are compared in copies
with one inserted. A group that happens to be mentioned in toxic texts, or whose name begins like a toxic word,
then carries no weight of its own, and neutral mentions stay below the threshold.
"""

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.llm.common import text_column, worker_table
from tenura.session import written_table

#: Terms for groups of people, swapped for one another inside a row.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "feminists", "mothers", "fathers"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "lesbian", "straight", "transgender", "bisexual", "queer"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("immigrants", "refugees", "foreigners", "natives", "migrants"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "christen", "juden", "hindus"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "hindous"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("musulmanes", "cristianos", "judíos", "hindúes"),
)
_ROW = {t: row for row in IDENTITY_TERMS for t in row}
EDGE = ".,;:!?\"'()[]{}<>*#$%&…«»“”„-_/\\|~`^+="


def words_of(text: str) -> list[str]:
    return text.lower().split()


def features_of(word: str) -> tuple[str, ...]:
    """A word without marks at its ends, and its first four and five letters for forms not seen before."""
    bare = word.strip(EDGE)
    if not bare:
        return ()
    return (bare, *(f"{bare[:n]}~" for n in (4, 5) if len(bare) > n))


def swapped(words: set[str]) -> list[set[str]]:
    """All twins of a word set: the k-th has every identity term replaced by the k-th next of its row, until the
    longest row present has come around. Empty without such a term."""
    terms = {w: _ROW[w.strip(EDGE)] for w in words if w.strip(EDGE) in _ROW}
    out = []
    for k in range(1, max(map(len, terms.values()), default=1)):
        twin = words.difference(terms)
        for w, row in terms.items():
            twin.add(row[(row.index(w.strip(EDGE)) + k) % len(row)])
        out.append(twin)
    return out


def counterfactuals(words: set[str]) -> tuple[set[str], list[set[str]]]:
    """The word set that is compared and its twins. Where it holds no identity term, that is a copy with one
    inserted, which one by hash of the words; the order of words is no input of a score, so neither is the place."""
    twins = swapped(words)
    if not twins:
        row = IDENTITY_TERMS[zlib.crc32(" ".join(sorted(words)).encode()) % len(IDENTITY_TERMS)]
        words = words | {row[0]}
        twins = swapped(words)
    return words, twins


@dataclass(frozen=True)
class Model:
    """Weights by feature, at most `max_features` of them, so a model is small enough to send anywhere."""

    weights: dict
    bias: float

    def score(self, text: str, cache: dict) -> float:
        z = self.bias + sum(map(cache.__getitem__, set(words_of(text))))
        return 1 / (1 + math.exp(-min(max(z, -500), 500)))


class _WordWeights(dict):
    def __init__(self, weights: dict, room: int = 200_000):
        self.weights, self.room = weights, room

    def __missing__(self, word: str) -> float:
        got = self.weights.get
        v = math.fsum(got(f, 0.0) for f in features_of(word))
        if len(self) >= self.room:
            self.clear()
        if len(word) <= 64:
            self[word] = v
        return v


def in_training(doc_id: Column) -> Column:
    """Rows that may be learnt from: crc32 of the id as text, mod 5, is not 0."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) != 0


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with each feature by class, summed before the shuffle; flushed at a bounded size."""
    schema = pa.schema([("feature", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])
    held = (Counter(), Counter())

    def out() -> pa.RecordBatch:
        names = list(held[0].keys() | held[1].keys())
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *(pa.array([c[n] for n in names], pa.int64()) for c in (held[1], held[0]))], schema=schema)

    for batch in batches:
        for y, times, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            for f in {f for w in set(words_of(text.as_py())) for f in features_of(w)}:
                held[y][f] += times
            if len(held[0]) + len(held[1]) > 150_000:
                yield out()
                held[0].clear()
                held[1].clear()
    if held[0] or held[1]:
        yield out()


ENCODED = "toxic int, times long, at array<int>, moves array<struct<first:array<int>,second:array<int>>>"


def _encode(index: dict, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chosen features in each labelled text, and for each of its pairs of twins what the two hold beyond the
    text; a feature that goes is written as -1 - its place."""
    move = pa.struct([("first", pa.list_(pa.int32())), ("second", pa.list_(pa.int32()))])
    schema = pa.schema([("toxic", pa.int32()), ("times", pa.int64()), ("at", pa.list_(pa.int32())), ("moves", pa.list_(move))])

    def places(words: set[str]) -> list[int]:
        return [index[f] for w in words for f in features_of(w) if f in index]

    def beyond(words: set[str], other: set[str]) -> list[int]:
        return places(other - words) + [-1 - k for k in places(words - other)]

    for batch in batches:
        rows = []
        for y, times, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            words = set(words_of(text.as_py()))
            first, twins = counterfactuals(words)
            moves = [{"first": beyond(words, first), "second": beyond(words, t)} for t in twins]
            rows.append((y, times, places(words), moves))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _matrix(rows: list[list[int]], width: int):
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.fromiter((c for r in rows for c in r), np.int64, len(at))
    n = len(rows)
    return (lambda w: np.bincount(at, w[col], n)), (lambda g: np.bincount(col, g[at], width))


def _signed(rows: list[list[int]], width: int):
    """As `_matrix`, for rows in which -1 - place takes the place's weight away."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.fromiter((c for r in rows for c in r), np.int64, len(at))
    sign, col, n = np.where(col < 0, -1.0, 1.0), np.where(col < 0, -1 - col, col), len(rows)
    return (lambda w: np.bincount(at, sign * w[col], n)), (lambda g: np.bincount(col, sign * g[at], width))


def fit_weights(y: np.ndarray, rows: list[list[int]], twins: list, width: int, swap_penalty: float = 5.0, l2: float = 1e-3,
                steps: int = 400, times: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Minimise mean log loss + swap_penalty * mean (score - score of a twin)^2 + l2 |w|^2 by Adam.

    `twins` has per row None, the features of one twin of the row itself, or a list of moves
    {"first", "second"}: what the two texts of a pair hold beyond the row. The pairs of a row count as much as one
    together. Classes weigh the same in all, so a rare label still moves the threshold to where they part; a row
    counts `times` times. With one class only, the bias alone says which.
    """
    times = np.ones(len(y)) if times is None else times
    n_toxic, n_all = float(times[y == 1].sum()), float(times.sum())
    if not n_toxic or n_toxic == n_all:
        return np.zeros(width), 0.0 if not len(y) else (4.0 if n_toxic else -4.0)
    weight = times * np.where(y == 1, 0.5 / n_toxic, 0.5 / (n_all - n_toxic))
    forward, backward = _matrix(rows, width)
    pairs = []                                                  # row, share, first, second
    for k, t in enumerate(twins):
        if t and isinstance(t[0], dict):
            pairs += [(k, times[k] / len(t), m["first"], m["second"]) for m in t]
        elif t is not None:
            pairs.append((k, times[k], [], [*t, *(-1 - c for c in rows[k])]))
    of = np.array([p[0] for p in pairs], np.int64)
    share = np.array([p[1] for p in pairs])
    first, first_t = _signed([p[2] for p in pairs], width)
    second, second_t = _signed([p[3] for p in pairs], width)
    w, b = np.zeros(width), 0.0
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1):
        z = forward(w) + b
        r = weight * (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y)
        g = l2 * w
        if pairs:
            p1 = 1 / (1 + np.exp(-np.clip(z[of] + first(w), -60, 60)))
            p2 = 1 / (1 + np.exp(-np.clip(z[of] + second(w), -60, 60)))
            d = 2 * swap_penalty * share * (p1 - p2) / share.sum()
            g1, g2 = d * p1 * (1 - p1), -d * p2 * (1 - p2)
            g = g + first_t(g1) + second_t(g2)
            r = r + np.bincount(of, g1 + g2, len(rows))
        grad = np.append(g + backward(r), r.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        move = 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 24_000, max_features: int = 4_096,
          swap_penalty: float = 5.0) -> Model:
    """Fit on labelled rows that are not held out, at most about `max_rows` different ones, half for each class where
    there are so many; chosen by hash of their id, and by hash of their text where one id has many texts.

    Features are chosen by how much their share differs between the classes (chi-square over all rows of
    the sample, beyond chance for as many features as were tested), at most `max_features`; those of the identity
    terms are always among them. Rows with a null id, label or text are not learnt from; a repeated document or
    label counts as often as it occurs, by a weight. Without labelled rows, or with an empty table, the model
    scores everything 0.5 less a little, so nothing is rejected.
    """
    known = labels.where(in_training(labels["doc_id"]) & labels["toxic"].isin(0, 1)).select(
        labels["doc_id"].alias("label_id"), labels["toxic"].cast("int").alias("y")) \
        .where("label_id IS NOT NULL").groupBy("label_id", "y").agg(F.count("*").alias("labelled"))
    size = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = F.create_map(*[F.lit(x) for k, n in size.items() for x in (k, min(1.0, max_rows / 2 / n))]) if size else F.lit(None)
    draw = F.pmod(F.xxhash64("label_id"), F.lit(1_000_000)) / 1_000_000
    picked = known.where(draw < share[F.col("y")]) if size else known.where("false")
    # About max_rows different ids are broadcast; rows repeated under an id are one row with a weight.
    texts = docs.where(docs["text"].isNotNull()).select(docs["doc_id"].alias("label_id"), docs["text"].cast("string").alias("text"))
    sample = written_table(docs.sparkSession, texts.join(F.broadcast(picked), "label_id").groupBy("y", "text").agg(F.sum("labelled").alias("times")))
    found = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    part = F.pmod(F.xxhash64("text", "y"), F.lit(1_000_000)) / 1_000_000
    for label, rows in found.items():
        if rows > 0.75 * max_rows:                              # ids with many different texts
            sample = sample.where((F.col("y") != label) | (part < max_rows / 2 / rows))
    n = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.sum("times").alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return Model({}, -1.0 if not n1 else 1.0)
    sample = sample.select("y", "times", "text")
    counts = sample.mapInArrow(_feature_counts, "feature string, toxic long, clean long")
    counts = counts.groupBy("feature").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    both = a + b
    chi2 = (F.lit(float(n1 + n0)) * F.pow(a * (n0 - b) - b * (n1 - a), 2)
            / (both * (n1 + n0 - both) * float(n1) * float(n0)))
    tested = written_table(docs.sparkSession, counts.where((both >= 3) & (both < n1 + n0)).select("feature", chi2.alias("chi2")))
    strong = tested.where(F.col("chi2") >= beyond_chance(tested.count()))
    names = [r["feature"] for r in strong.orderBy(F.desc("chi2"), "feature").limit(max_features).collect()]
    names += sorted({f for t in _ROW for f in features_of(t)}.difference(names))
    index = {f: k for k, f in enumerate(names)}
    rows = sample.mapInArrow(lambda x: _encode(index, x), ENCODED).toArrow()
    rows = sorted(zip(*(rows.column(k).to_pylist() for k in range(4))), key=repr)
    w, bias = fit_weights(np.array([r[0] for r in rows]), [r[2] for r in rows], [r[3] for r in rows], len(names), swap_penalty,
                          times=np.array([r[1] for r in rows], float))
    return Model({f: float(x) for f, x in zip(names, w) if x}, float(bias))


def beyond_chance(tests: int, p: float = 0.05) -> float:
    """Chi-square (one degree of freedom) that none of so many tests reaches by chance, with probability 1 - p:
    the tail p / tests by its leading terms."""
    double = 2 * math.log(max(tests, 1) / p)
    return double - math.log(double) - math.log(math.pi / 2)


SCORED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()),
                       T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= 0.5) for every row; null text is empty and has the score of
    no words. Only the text is an input of the score. A null doc_id is not held out. Repeated rows and equal texts
    have equal scores, long texts are read whole, an empty table gives no row, other columns are not read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _WordWeights(model.weights)
        for batch in batches:
            scores = [model.score(x.as_py(), cache) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()),
                 pa.array([int(s >= 0.5) for s in scores], pa.int32())], names=["doc_id", "held_out", "score", "predicted"])

    held_out = F.coalesce(~in_training(docs["doc_id"]), F.lit(False))
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), held_out.alias("held_out"),
                       text_column(docs).alias("text")).mapInArrow(run, SCORED)


def reject_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` that the model does not reject (score below 0.5), columns as they are, whatever their names.
    Null text counts as empty; repeated rows stay or go together; an empty table stays empty."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_table("none", None)
        cache = _WordWeights(model.weights)
        for batch in batches:
            keep = [model.score(x.as_py() or "", cache) < 0.5 for x in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def counterfactual_gap(docs: DataFrame, labels: DataFrame, model: Model) -> DataFrame:
    """How far the score depends on the group, over labelled texts that are held out: toxic, pairs (of a text, or its
    copy with a term inserted, and a twin), mean_gap and max_gap of the two scores. Null texts count as empty;
    repeated rows count as often as they occur."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _WordWeights(model.weights)
        for batch in batches:
            rows = []
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words, twins = counterfactuals(set(words_of(text.as_py())))
                base = model.score(" ".join(words), cache)
                gaps = [abs(base - model.score(" ".join(t), cache)) for t in twins]
                rows.append((y, len(gaps), math.fsum(gaps), max(gaps)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 4, (pa.int32(), pa.int64(), pa.float64(), pa.float64()))],
                names=["toxic", "pairs", "total", "most"])

    held = labels.where(~in_training(labels["doc_id"]) & labels["toxic"].isin(0, 1)).select(
        labels["doc_id"].alias("label_id"), labels["toxic"].cast("int").alias("toxic"))
    texts = docs.select(docs["doc_id"].alias("label_id"), text_column(docs).alias("text"))
    gaps = texts.join(held, "label_id").select("toxic", "text").mapInArrow(run, "toxic int, pairs long, total double, most double")
    return gaps.groupBy("toxic").agg(F.sum("pairs").alias("pairs"), (F.sum("total") / F.sum("pairs")).alias("mean_gap"),
                                     F.max("most").alias("max_gap"))

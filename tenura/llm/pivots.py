"""Exact top-k by inner product with pivot-table elimination.

Every vector's distances to a set of pivots are computed once and written. For a query and a candidate the
largest difference of their distances to a common pivot is a lower bound of their own distance, so an upper
bound of the inner product. Candidates are evaluated in the order of their bounds until no bound is left that
could reach the k-th best score.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.llm.common import by_task
from tenura.llm.vectors import as_bytes, bounded_sample, matrix, usable
from tenura.session import written_table

EXACT = 2.0 ** 53
LONG = (1 << 63) - 1
FOUND = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("query_key", T.LongType()),
                      T.StructField("vec_id", T.LongType()), T.StructField("score", T.LongType())])


def choose_pivots(sample: np.ndarray, n_pivots: int) -> np.ndarray:
    """Farthest-first: each pivot is the row farthest from those before it. Stops at repeated rows."""
    if not len(sample):
        return sample
    sample = sample[np.lexsort(sample.T)]
    picked = [0]
    far = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(picked) < n_pivots and far.max() > 0:
        k = int(far.argmax())
        picked.append(k)
        far = np.minimum(far, ((sample - sample[k]) ** 2).sum(axis=1))
    return sample[picked]


def pivot_table(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """vectors (vec_id, dim, v) with `d`, the distances to the pivots of their dimension, as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for dim, data in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                p = pivots.get(dim)
                x = np.frombuffer(data, "<f8")
                out.append(b"" if p is None else np.sqrt(((p - x) ** 2).sum(axis=1)).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=["vec_id", "dim", "v", "d"])

    return vectors.select("vec_id", "dim", "v").mapInArrow(run, "vec_id long, dim int, v binary, d binary")


def _bounds(q: np.ndarray, q_far: np.ndarray, x: np.ndarray, x_far: np.ndarray) -> np.ndarray:
    """Upper bounds of the inner products, above any rounding: of the distances too, whose error grows with the
    pivot's own distance. Where doubles overflow the bound is infinite."""
    with np.errstate(over="ignore", invalid="ignore"):
        square = (q * q).sum() + (x * x).sum(axis=1)
        near = np.abs(x_far - q_far) - (x_far + q_far) * ((len(q) + 8) * 2.0 ** -52)
        near = np.where(np.isfinite(near) & (near > 0), near, 0.0)
        near = near.max(axis=1) if near.shape[1] else np.zeros(len(x))
        bound = (square - near * near) / 2 + square * 1e-9 + 1
    return np.where(np.isnan(bound), np.inf, bound)


def _whole(q: np.ndarray, x: np.ndarray) -> list[int]:
    """Inner products by whole numbers of any size, held at the range's end."""
    a = [int(c) for c in q]
    return [max(-LONG - 1, min(LONG, sum(c * int(d) for c, d in zip(a, row)))) for row in x]


def top_of_block(q: np.ndarray, q_far: np.ndarray, x: np.ndarray, x_far: np.ndarray, ids: np.ndarray, own: int, k: int,
                 step: int = 256) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids and scores of the k best rows of x for q, ties to the smaller id, and how many were evaluated. Only rows
    whose product may round in doubles are evaluated by whole numbers."""
    bound = _bounds(q, q_far, x, x_far)
    bound[ids == own] = -np.inf
    order = np.argsort(-bound, kind="stable")
    with np.errstate(over="ignore"):
        rounds = np.abs(x).max(axis=1, initial=0.0) * np.abs(q).max(initial=0.0) * x.shape[1] >= EXACT
    got_ids, got, seen = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    at, size = 0, step
    while at < len(order):
        size = min(size, 16) if rounds[order[at]] else step       # whole numbers are slow: fewer at a time
        part = order[at:at + size]
        at += size
        part = part[bound[part] > -np.inf]
        # int() because a bound is compared with the exact score, not with its double; a score at the range's
        # lower end may stand for a smaller one
        if not len(part) or len(got) == k and got[-1] > -LONG - 1 and bound[part[0]] < int(got[-1]):
            break
        scores = np.zeros(len(part), np.int64)
        large = rounds[part]
        scores[~large] = (x[part[~large]] @ q).astype(np.int64)
        if large.any():
            scores[large] = _whole(q, x[part[large]])
        got_ids, got = np.r_[got_ids, ids[part]], np.r_[got, scores]
        seen += len(part)
        best = np.lexsort((got_ids, ~got))[:k]                    # ~ turns the order round without overflow
        got_ids, got = got_ids[best], got[best]
    return got_ids, got, seen


def _search(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(f.name, pa.int64()) for f in FOUND.fields])
    for run in by_task(["dim", "query_block", "block"], batches):
        is_query = run.column("is_query").to_numpy()
        if is_query.all() or not is_query.any():
            continue
        ids, v, d = run.column("vec_id").to_numpy(), matrix(run.column("v")), matrix(run.column("d"))
        keys = run.column("query_key").to_numpy()
        x, x_far, x_ids = v[~is_query], d[~is_query], ids[~is_query]
        rows = []
        for at in np.flatnonzero(is_query).tolist():
            got_ids, got, _ = top_of_block(v[at], d[at], x, x_far, x_ids, ids[at], k)
            rows += [(ids[at], keys[at], i, s) for i, s in zip(got_ids.tolist(), got.tolist())]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)


def top_k(vectors: DataFrame, k: int = 5, scale: float = 256.0, query_every: int = 50, n_pivots: int = 32,
          sample_rows: int = 2_048, query_rows: int = 2_048, block_rows: int = 4_096) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows with the largest integer inner product for every row
    whose vec_id is divisible by `query_every`, all other rows being candidates.

    Components become floor(scale * x). Vectors that are null, empty or hold null or non-finite components
    take no part, nor do rows without vec_id; vectors of another length than the query's are no candidates of
    it. Rows repeated in full count once. Rows with the query's id are its own; an id with several vectors is
    a query for each. Ties go to the smaller vec_id. Sums beyond 64 bits are held at the range's end. Other
    columns are not read.

    Pivots are chosen on about `sample_rows` rows; exactness does not depend on them. Queries and candidates
    are dealt to a grid of blocks, so tasks are bounded whatever the number of queries; each cell returns k
    rows for each of its queries, and the ranking drops the rest before its shuffle.
    """
    spark = vectors.sparkSession
    rows = vectors.where(usable(vectors["embedding"]) & vectors["vec_id"].isNotNull())
    rows = rows.select(rows["vec_id"].cast("long").alias("vec_id"), rows["embedding"].alias("v"))
    rows = as_bytes(rows, "v", "<f8", lambda x: np.floor(x * scale)).dropDuplicates(["vec_id", "v"])
    rows = written_table(spark, rows)
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n"),
                                    F.count(F.when(F.col("vec_id") % query_every == 0, 1)).alias("n_queries"))
    total = rows.count()
    sample = bounded_sample(rows, total, sample_rows, "vec_id").select("dim", "v").toArrow()
    pivots = {}
    for dim in sorted(set(sample.column("dim").to_pylist())):
        x = matrix(sample.filter(pc.equal(sample.column("dim"), dim)).column("v"))
        pivots[dim] = choose_pivots(x, n_pivots)
    placed = written_table(spark, pivot_table(rows, pivots))
    grid = sizes.where("n_queries > 0").select(
        "dim", F.ceil(F.col("n") / block_rows).cast("int").alias("n_blocks"),
        F.ceil(F.col("n_queries") / query_rows).cast("int").alias("n_query_blocks"))
    own = placed.join(grid, "dim").withColumn("query_key", F.xxhash64("v"))
    deal = F.xxhash64("vec_id", F.lit(3))
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    candidates = own.withColumn("block", F.pmod(deal, F.col("n_blocks")).cast("int"))
    candidates = candidates.select("*", upto("n_query_blocks").alias("query_block"), F.lit(False).alias("is_query"))
    queries = own.where(F.col("vec_id") % query_every == 0)
    queries = queries.withColumn("query_block", F.pmod(deal, F.col("n_query_blocks")).cast("int"))
    queries = queries.select("*", upto("n_blocks").alias("block"), F.lit(True).alias("is_query"))
    keys = ["dim", "query_block", "block"]
    cells = candidates.unionByName(queries).select(*keys, "is_query", "vec_id", "query_key", "v", "d")
    cells = cells.repartition(*keys).sortWithinPartitions(*keys)
    found = cells.mapInArrow(lambda b: _search(k, b), FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

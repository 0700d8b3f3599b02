"""Many k-means runs side by side: the centres of all (k, start) runs move in one scan per iteration.

The driver holds centres and sums, a few numbers for each run, nothing that grows with the customers.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tenura.operators.ordering import hash_order

SUMS = "run int, cluster int, n long, cost double, total array<double>, squares double"


@dataclass(frozen=True)
class Run:
    """One finished run: its centres, and of each cluster its size, sum of points and of squared lengths."""
    k: int
    centres: np.ndarray
    cost: float
    sizes: np.ndarray
    totals: np.ndarray
    squares: np.ndarray


def first_centres(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++: of a few sample points, drawn in proportion to their squared distance from the nearest centre, the one
    that lowers the cost most is the next centre. A sample with fewer different points gives fewer centres."""
    rng = np.random.default_rng(seed)
    centres = sample[[rng.integers(len(sample))]]
    while len(centres) < k:
        apart = ((sample[:, None, :] - centres[None]) ** 2).sum(axis=2).min(axis=1)
        if apart.sum() <= 0:
            break
        drawn = sample[rng.choice(len(sample), 2 + int(np.log(k)), p=apart / apart.sum())]
        costs = np.minimum(apart, ((sample[None] - drawn[:, None]) ** 2).sum(axis=2)).sum(axis=1)
        centres = np.vstack([centres, drawn[costs.argmin()]])
    return centres


def settled(sample: np.ndarray, centres: np.ndarray, iterations: int, tolerance: float) -> np.ndarray:
    """The centres after k-means on the sample alone, so that few scans of all rows are left."""
    squares = (sample ** 2).sum(axis=1)
    for _ in range(iterations):
        at, _ = next(_Centres([centres]).nearest(sample, squares))
        sizes = np.bincount(at, minlength=len(centres))
        totals = np.column_stack([np.bincount(at, x, len(centres)) for x in sample.T])
        new = np.where(sizes[:, None] > 0, totals / np.maximum(sizes, 1)[:, None], centres)
        if ((new - centres) ** 2).sum(axis=1).max() <= tolerance ** 2:
            break
        centres = new
    return centres


def _points(columns: list[pa.Array]) -> np.ndarray:
    return np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns])


class _Centres:
    """The centres of all runs below each other, so that a block of points meets them in one product."""

    def __init__(self, runs: list[np.ndarray]):
        self.cuts = np.cumsum([0, *map(len, runs)])
        self.all = np.vstack(runs)
        self.squares = (self.all ** 2).sum(axis=1)

    def nearest(self, points: np.ndarray, squares: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each run the nearest centre of every point, the first of equally near ones, and the squared distance."""
        apart = self.squares - 2 * points @ self.all.T
        for lo, hi in zip(self.cuts, self.cuts[1:]):
            at = apart[:, lo:hi].argmin(axis=1)
            yield at, np.maximum(apart[np.arange(len(points)), lo + at] + squares, 0)


def step(points: DataFrame, columns: list[str], runs: dict[int, np.ndarray]) -> dict[int, Run]:
    """Every point meets its nearest centre of every run: one scan, one row per task, run and cluster to the aggregation."""
    width = len(columns)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = _Centres(list(runs.values()))
        held = {r: (np.zeros(len(c), np.int64), np.zeros(len(c)), np.zeros((len(c), width)), np.zeros(len(c))) for r, c in runs.items()}
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = _points([c.slice(lo, 4096) for c in batch.columns])
                squares = (part ** 2).sum(axis=1)
                for r, (at, apart) in zip(runs, centres.nearest(part, squares)):
                    n, cost, total, square = held[r]
                    k = len(n)
                    n += np.bincount(at, minlength=k)
                    cost += np.bincount(at, apart, k)
                    square += np.bincount(at, squares, k)
                    for d in range(width):
                        total[:, d] += np.bincount(at, part[:, d], k)
        rows = [(r, c, int(n[c]), float(cost[c]), total[c].tolist(), float(square[c]))
                for r, (n, cost, total, square) in held.items() for c in np.flatnonzero(n).tolist()]
        if rows:
            schema = pa.schema([("run", pa.int32()), ("cluster", pa.int32()), ("n", pa.int64()), ("cost", pa.float64()),
                                ("total", pa.list_(pa.float64())), ("squares", pa.float64())])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    sums = points.select(columns).mapInArrow(scan, SUMS).groupBy("run", "cluster").agg(
        F.sum("n").alias("n"), F.sum("cost").alias("cost"), F.sum("squares").alias("squares"),
        *[F.sum(F.col("total")[d]).alias(f"t{d}") for d in range(width)])
    out = {r: Run(len(c), c.copy(), 0.0, np.zeros(len(c), np.int64), np.zeros((len(c), width)), np.zeros(len(c))) for r, c in runs.items()}
    costs = dict.fromkeys(runs, 0.0)
    for row in sorted(sums.collect()):        # at most one row for each centre
        run, c = out[row.run], row.cluster
        run.sizes[c], run.squares[c] = row.n, row.squares
        run.totals[c] = [row[f"t{d}"] for d in range(width)]
        costs[row.run] += row.cost
    return {r: Run(run.k, run.centres, costs[r], run.sizes, run.totals, run.squares) for r, run in out.items()}


def moved(run: Run) -> np.ndarray:
    """Means of the clusters; an empty one stays where it is."""
    return np.where(run.sizes[:, None] > 0, run.totals / np.maximum(run.sizes, 1)[:, None], run.centres)


def settle(points: DataFrame, columns: list[str], centres: dict[int, np.ndarray], iterations: int = 100,
           tolerance: float = 1e-4) -> dict[int, Run]:
    """Moves the centres of all runs together until no centre of a run moves further than `tolerance`."""
    centres, done = dict(centres), {}
    for _ in range(iterations):
        if not centres:
            break
        for i, run in step(points, columns, centres).items():
            new = moved(run)
            if ((new - run.centres) ** 2).sum(axis=1).max() <= tolerance ** 2:
                done[i] = run
                del centres[i]
            else:
                centres[i] = new
    return done | step(points, columns, centres) if centres else done


def fit_all(points: DataFrame, columns: list[str], asked: list[tuple[int, int]], key: str = "customer_id", sample: int = 2048,
            iterations: int = 100, tolerance: float = 0.01) -> list[Run]:
    """One Run per (k, seed) of `asked`, in order. A run ends when no centre moves further than `tolerance`, by default a
    hundredth of a standard deviation of scaled columns.

    First centres are k-means++ centres of the `sample` smallest rows by hash of `key`, moved by those rows until they
    settle; from there on all rows move them, and a run ends as a fixed point of all rows. Runs that
    have ended leave the scan. `points` should be cached or written: it is scanned once per iteration. Columns must not
    be null; an empty table has runs without centres.
    """
    drawn = points.orderBy(hash_order("centres", key), key).limit(sample).select(columns).toPandas().to_numpy(float)
    if not len(drawn):
        return [Run(0, np.zeros((0, len(columns))), 0.0, np.zeros(0, np.int64), np.zeros((0, len(columns))), np.zeros(0)) for _ in asked]
    centres = {i: settled(drawn, first_centres(drawn, k, seed), iterations, tolerance) for i, (k, seed) in enumerate(asked)}
    done = settle(points, columns, centres, iterations, tolerance)
    return [done[i] for i in range(len(asked))]


def nearest(columns: list[str], centres: np.ndarray) -> Column:
    """Number of the nearest centre, the first of equally near ones."""
    apart = [F.lit(0.0) + sum((F.col(c) - F.lit(float(x))) * (F.col(c) - F.lit(float(x))) for c, x in zip(columns, centre))
             for centre in centres]
    return (F.array_position(F.array(*apart), F.least(*apart) if len(apart) > 1 else apart[0]) - 1).cast("int")


def silhouettes(points: DataFrame, columns: list[str], runs: list[Run]) -> list[float]:
    """Mean silhouette on squared distances of every run, all in one scan.

    The mean squared distance from a point to a cluster follows from the cluster's size, sum and squared lengths, so
    points never meet. A point alone in its cluster counts 0, as do all points of a run with one cluster.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = _Centres([run.centres for run in runs])
        total, n = np.zeros(len(runs)), 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = _points([c.slice(lo, 4096) for c in batch.columns])
                n += len(part)
                length = (part ** 2).sum(axis=1)
                for r, (run, (at, _)) in enumerate(zip(runs, centres.nearest(part, length))):
                    if (run.sizes > 0).sum() < 2:
                        continue
                    mean = length[:, None] + (run.squares - 2 * part @ run.totals.T) / np.maximum(run.sizes, 1)
                    mine, size = mean[np.arange(len(part)), at], run.sizes[at]
                    inside = mine * size / np.maximum(size - 1, 1)
                    mean[:, run.sizes == 0] = np.inf
                    mean[np.arange(len(part)), at] = np.inf
                    outside = mean.min(axis=1)
                    most = np.maximum(inside, outside)
                    total[r] += np.where((size > 1) & (most > 0), (outside - inside) / np.where(most > 0, most, 1), 0).sum()
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(runs)), pa.int32()), pa.array(total), pa.array([n] * len(runs), pa.int64())], names=["run", "s", "n"])

    rows = points.select(columns).mapInArrow(scan, "run int, s double, n long").groupBy("run").agg(
        (F.sum("s") / F.sum("n")).alias("silhouette")).collect()            # one row per run
    found = {row.run: row.silhouette for row in rows}
    return [found.get(r, 0.0) for r in range(len(runs))]

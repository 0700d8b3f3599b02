"""Embedding near-dedup by an inverted multi-index.

Each half of the vector space has a codebook of its own; their product is a grid of cells, and every vector is
in the cell of its two nearest codes. A vector visits cells in the order of the summed distances of their
codes (multi-sequence order), as many as it takes to meet the target recall, and what it finds there is
verified by cosine in double precision.
"""

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.llm.common import Groups, by_task
from tenura.llm.graph import components
from tenura.llm.vectors import as_bytes, bounded_sample, matrix, usable
from tenura.session import written_table


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled by their largest component first, so no square runs over."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_codes(x: np.ndarray, n_codes: int, rounds: int = 12) -> np.ndarray:
    """k-means codes of a half space, starting from evenly spread rows of the sample."""
    codes = x[np.linspace(0, len(x) - 1, min(n_codes, len(x))).astype(int)].copy()
    for _ in range(rounds):
        near = distances(x, codes).argmin(axis=1)
        for k in range(len(codes)):
            own = x[near == k]
            if len(own):
                codes[k] = own.mean(axis=0)
    return codes


def distances(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    d = (x * x).sum(axis=1)[:, None] - 2 * x @ codes.T + (codes * codes).sum(axis=1)[None, :]
    return np.maximum(d, 0)


def multi_sequence(d1: np.ndarray, d2: np.ndarray, n: int) -> list[tuple[int, int]]:
    """The n cells (i, j) with the smallest d1[i] + d2[j], nearest first. A cell enters the queue once its
    neighbours before it, in the order of either half, have left."""
    o1, o2 = np.argsort(d1, kind="stable").tolist(), np.argsort(d2, kind="stable").tolist()
    a, b = d1[o1].tolist(), d2[o2].tolist()
    queue, out, gone = [(a[0] + b[0], 0, 0)], [], set()
    while queue and len(out) < n:
        _, i, j = heapq.heappop(queue)
        out.append((o1[i], o2[j]))
        gone.add((i, j))
        if i + 1 < len(a) and (j == 0 or (i + 1, j - 1) in gone):
            heapq.heappush(queue, (a[i + 1] + b[j], i + 1, j))
        if j + 1 < len(b) and (i == 0 or (i - 1, j + 1) in gone):
            heapq.heappush(queue, (a[i] + b[j + 1], i, j + 1))
    return out


@dataclass(frozen=True)
class MultiIndex:
    """Codebooks of the halves (vectors are padded with zeros to `width`) and the number of cells to visit."""

    first: np.ndarray
    second: np.ndarray
    width: int
    visits: int

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances to the codes of either half."""
        x = np.pad(x, ((0, 0), (0, self.width - x.shape[1])))
        cut = self.width // 2
        return distances(x[:, :cut], self.first), distances(x[:, cut:], self.second)

    def cells(self, x: np.ndarray) -> np.ndarray:
        d1, d2 = self.halves(x)
        return d1.argmin(axis=1) * len(self.second) + d2.argmin(axis=1)

    def visited(self, x: np.ndarray) -> list[list[int]]:
        d1, d2 = self.halves(x)
        return [[i * len(self.second) + j for i, j in multi_sequence(p, q, self.visits)] for p, q in zip(d1, d2)]


def fit_index(sample: np.ndarray, n_rows: int, threshold: float, recall: float, cell_rows: int, max_codes: int) -> MultiIndex:
    """Codebooks from sample rows (unit length); visits such that a share `recall` of vectors at exactly the
    threshold from a sample row, in random directions, lie in a visited cell. Closer ones are found more often."""
    width = sample.shape[1]
    n_codes = int(max(1, min(max_codes, round((n_rows / cell_rows) ** 0.5))))
    cut = width // 2
    first, second = fit_codes(sample[:, :cut], n_codes), fit_codes(sample[:, cut:], n_codes)
    every = MultiIndex(first, second, width, len(first) * len(second))
    rng = np.random.RandomState(11)
    probe = sample[rng.permutation(len(sample))[:512]]
    away = rng.normal(size=probe.shape)
    away -= (away * probe).sum(axis=1, keepdims=True) * probe
    norm = np.sqrt((away * away).sum(axis=1, keepdims=True))
    other = threshold * probe + (1 - threshold ** 2) ** 0.5 * np.divide(away, norm, out=np.zeros_like(away), where=norm > 0)
    d1, d2 = every.halves(probe)
    home = every.cells(other)
    total = (d1[:, :, None] + d2[:, None, :]).reshape(len(probe), -1)
    rank = (total < total[np.arange(len(probe)), home][:, None]).sum(axis=1)
    visits = int(np.quantile(rank, recall, method="higher")) + 1
    return MultiIndex(first, second, width, visits)


def _place(index: MultiIndex, dtype: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes (node, dim, v, copies) with their cell and the cells they visit."""
    schema = pa.schema([("node", pa.binary()), ("dim", pa.int32()), ("v", pa.binary()), ("copies", pa.int64()),
                        ("cell", pa.int32()), ("visits", pa.list_(pa.int32()))])
    for batch in batches:
        for dim in sorted(set(batch.column(1).to_pylist())):
            part = batch.filter(pc.equal(batch.column(1), dim))
            x = unit(matrix(part.column(2), dtype).astype("<f8"))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(index.cells(x), pa.int32()), pa.array(index.visited(x), pa.list_(pa.int32()))],
                schema=schema)


LINKS = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType()), T.StructField("n_links", T.LongType())])


def _verify(dtype: str, threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells to link counts (b null) and connecting edges (n_links null). A pair counts where the smaller node
    probes the larger one's cell, so once."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("n_links", pa.int64())])
    for run in by_task(["dim", "cell", "block", "probe_block"], batches):
        probes = run.column("is_probe").to_numpy()
        if probes.all() or not probes.any():
            continue
        nodes, copies = np.array(run.column("node").to_pylist(), object), run.column("copies").to_numpy()
        x = matrix(run.column("v"), dtype).astype("<f8")
        x = x / np.abs(x).max(axis=1, keepdims=True)
        norm = np.sqrt((x * x).sum(axis=1))
        data, asking = np.flatnonzero(~probes), np.flatnonzero(probes)
        rank = np.empty(len(nodes), np.int64)
        rank[np.argsort(nodes, kind="stable")] = np.arange(len(nodes))
        same = {}
        for k in range(len(nodes)):  # a node is here as data and as its own probe: one place in the union-find
            same.setdefault(nodes[k], k)
        place = np.array([same[v] for v in nodes])
        rank = rank[place]
        counts, groups, edges = np.zeros(len(nodes), np.int64), Groups(len(nodes)), []
        for at in range(0, len(asking), 512):
            part = asking[at:at + 512]
            cosine = (x[part] @ x[data].T) / (norm[part][:, None] * norm[data][None, :])
            p, d = np.nonzero((cosine >= threshold) & (rank[part][:, None] < rank[data][None, :]))
            if not len(p):
                continue
            p, d = part[p], data[d]
            counts += np.bincount(p, copies[d], len(nodes)).astype(np.int64) + np.bincount(d, copies[p], len(nodes)).astype(np.int64)
            edges += groups.join(place[p], place[d])
        rows = [(nodes[k], None, int(counts[k])) for k in np.flatnonzero(counts).tolist()]
        rows += [(nodes[a], nodes[b], None) for a, b in edges]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def near_vectors(vectors: DataFrame, threshold: float = 0.9, recall: float = 0.995, sample_rows: int = 8_192, cell_rows: int = 512,
                 max_codes: int = 256, block_rows: int = 2_048, probe_rows: int = 4_096) -> DataFrame:
    """One row per row of `vectors`: vec_id, n_links, component_id, kept.

    Vectors are linked if the index finds their pair and its cosine is at least `threshold`. `n_links` counts
    the other rows linked directly, equal vectors included; `component_id` is the smallest vec_id that links
    reach, its own included; `kept` is vec_id = component_id. Vectors that are null, empty, zero or hold null
    or non-finite components link with nothing, and vectors of different length not with each other. Rows
    repeating an id are rows of their own; a null id counts as larger than every other. Other columns are not
    read.

    Codebooks are fitted on about `sample_rows` rows; every row is indexed. Equal vectors are one node with a
    count. A cell's data and probes are dealt to blocks, so a cell that holds a third of all rows is spread
    over many tasks; no cell is capped. Pairs never become rows.
    """
    spark = vectors.sparkSession
    single = dict(vectors.dtypes)["embedding"] == "array<float>"
    dtype = "<f4" if single else "<f8"
    ids = vectors["vec_id"].cast("long")
    good = usable(vectors["embedding"]) & F.exists(vectors["embedding"], lambda c: c != 0)
    rows = vectors.where(good).select(ids.alias("vec_id"), (vectors["embedding"]).alias("v"))
    rows = as_bytes(rows, "v", dtype).withColumn("node", F.unhex(F.md5("v")))
    rows = written_table(spark, rows)
    nodes = rows.groupBy("node").agg(F.first("dim").alias("dim"), F.first("v").alias("v"), F.count("*").alias("copies"),
                                     F.min("vec_id").alias("first"))
    nodes = written_table(spark, nodes)
    n = nodes.count()
    if n:
        widths = nodes.agg(F.max("dim").alias("w")).first()["w"]
        sample = bounded_sample(nodes, n, sample_rows, "node").select("node", "dim", "v").toArrow().sort_by("node")
        x = [np.pad(np.frombuffer(v, dtype).astype("<f8"), (0, widths - d)) for d, v in zip(
            sample.column("dim").to_pylist(), sample.column("v").to_pylist())]
        index = fit_index(unit(np.array(x)), n, threshold, recall, cell_rows, max_codes)
        found = _linked(nodes, index, dtype, threshold, block_rows, probe_rows)
    else:
        found = spark.createDataFrame([], LINKS)
    found = written_table(spark, found)
    links = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n_links").alias("linked"))
    parts = components(found.where("b IS NOT NULL").select("a", "b"))
    classes = nodes.select("node", "copies", "first").join(parts, "node", "left")
    classes = classes.withColumn("component", F.coalesce("component", "node"))
    least = classes.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = classes.join(least, "component").join(links, "node", "left").select(
        "node", "component_id", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    linked = rows.select("vec_id", "node").join(classes, "node").select("vec_id", "n_links", "component_id")
    alone = vectors.where(~good | F.isnull(good)).select(ids.alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
                                                        ids.alias("component_id"))
    out = linked.unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _linked(nodes: DataFrame, index: MultiIndex, dtype: str, threshold: float, block_rows: int, probe_rows: int) -> DataFrame:
    spark = nodes.sparkSession
    schema = "node binary, dim int, v binary, copies long, cell int, visits array<int>"
    placed = written_table(spark, nodes.select("node", "dim", "v", "copies").mapInArrow(lambda b: _place(index, dtype, b), schema))
    asked = placed.select("node", "dim", F.explode("visits").alias("cell"))
    size = placed.groupBy("dim", "cell").agg(F.count("*").alias("n"))
    asks = asked.groupBy("dim", "cell").agg(F.count("*").alias("n_probes"))
    grid = size.join(asks, ["dim", "cell"]).select(
        "dim", "cell", F.ceil(F.col("n") / block_rows).cast("int").alias("n_blocks"),
        F.ceil(F.col("n_probes") / probe_rows).cast("int").alias("n_probe_blocks"))
    deal = F.xxhash64("node", F.lit(5))
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    data = placed.drop("visits").join(grid, ["dim", "cell"])
    data = data.withColumn("block", F.pmod(deal, F.col("n_blocks")).cast("int"))
    data = data.select("*", upto("n_probe_blocks").alias("probe_block"), F.lit(False).alias("is_probe"))
    probe = placed.select("node", "dim", "v", "copies", F.explode("visits").alias("cell")).join(grid, ["dim", "cell"])
    probe = probe.withColumn("probe_block", F.pmod(deal, F.col("n_probe_blocks")).cast("int"))
    probe = probe.select("*", upto("n_blocks").alias("block"), F.lit(True).alias("is_probe"))
    keys = ["dim", "cell", "block", "probe_block"]
    cells = data.unionByName(probe).select(*keys, "is_probe", "node", "v", "copies")
    cells = cells.repartition(*keys).sortWithinPartitions(*keys)
    return cells.mapInArrow(lambda b: _verify(dtype, threshold, b), LINKS)

"""Fitted models as tables, and customers scored from those tables.

* A tree model is a table of nodes: (model_name, tree, node, feature, threshold, left_values, left, right, value). A leaf
  leads to itself and carries what its tree adds to the score.
* A linear model or a net is a table of weights: (model_name, layer, target, source, weight); source -1 is the bias.

Both sizes follow from the settings of the models, not from the customers.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tenura.session import work_folder, written_table

NODES = ["model_name", "tree", "node", "feature", "threshold", "left_values", "left", "right", "value"]
WEIGHTS = "model_name string, layer int, target int, source int, weight double"


def node_table(name: str, model: PipelineModel, spark: SparkSession) -> DataFrame:
    """The nodes of a fitted forest or of boosted trees, read from the saved model's own table of nodes."""
    clf = model.stages[-1]
    path = work_folder(spark, "model")
    clf.write().save(path)
    weights = spark.createDataFrame([(i, float(x)) for i, x in enumerate(clf.treeWeights)], "tree int, tree_weight double")
    n = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*").join(weights, "tree")
    leaf, stats = F.col("leftChild") < 0, F.col("impurityStats")
    total = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    if isinstance(clf, RandomForestClassificationModel):        # a tree's vote is the share of class 1 in the leaf
        value = stats[1] / total * F.col("tree_weight") / sum(clf.treeWeights)
    else:
        value = F.col("prediction") * F.col("tree_weight")
    labels = F.col("split.numCategories") >= 0                  # one-hot columns are split by value
    table = n.select(
        F.lit(name).alias("model_name"), "tree", F.col("id").alias("node"),
        F.when(~leaf, F.col("split.featureIndex")).alias("feature"),
        F.when(~leaf & ~labels, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.when(~leaf & labels, F.col("split.leftCategoriesOrThreshold")).alias("left_values"),
        F.when(leaf, F.col("id")).otherwise(F.col("leftChild")).alias("left"),
        F.when(leaf, F.col("id")).otherwise(F.col("rightChild")).alias("right"),
        F.when(leaf, value).alias("value"))
    return written_table(spark, table)


def weight_table(name: str, model: PipelineModel, spark: SparkSession) -> DataFrame:
    """The weights of a fitted logistic model (one layer with one target) or net."""
    clf = model.stages[-1]
    rows = []
    if isinstance(clf, LogisticRegressionModel):
        rows = [(name, 0, 0, k, float(x)) for k, x in enumerate(clf.coefficients.toArray())]
        rows.append((name, 0, 0, -1, float(clf.intercept)))
    else:
        flat, at, sizes = clf.weights.toArray(), 0, clf.getLayers()
        for layer, (wide, out) in enumerate(zip(sizes, sizes[1:])):
            # a layer's weights lie source by source, its biases behind them
            rows += [(name, layer, t, s, float(flat[at + s * out + t])) for s in range(wide) for t in range(out)]
            at += wide * out
            rows += [(name, layer, t, -1, float(flat[at + t])) for t in range(out)]
            at += out
    return written_table(spark, spark.createDataFrame(rows, WEIGHTS))


def is_trees(model: PipelineModel) -> bool:
    return isinstance(model.stages[-1], (RandomForestClassificationModel, GBTClassificationModel))


class _Trees:
    """The nodes of all trees in arrays, tree behind tree; children are positions. A leaf leads to itself, and a child
    that is not in the table to a last node that adds nothing."""

    def __init__(self, nodes: pa.Table):
        def numbers(name, kind, null):
            return nodes[name].combine_chunks().fill_null(null).to_numpy(zero_copy_only=False).astype(kind)

        tree, node = numbers("tree", np.int64, 0), numbers("node", np.int64, 0)
        order = np.lexsort((node, tree))
        keys = (tree << 32 | node)[order]

        def place(child):
            wanted = (tree << 32 | numbers(child, np.int64, -1))[order]
            at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
            return np.append(np.where(keys[at] == wanted, at, len(keys)), len(keys)).astype(np.int32) if len(keys) else np.zeros(1, np.int32)

        feature = numbers("feature", np.int32, -1)[order]
        self.inner = np.append(feature >= 0, False)
        self.feature = np.append(np.maximum(feature, 0), 0)
        self.threshold = np.append(numbers("threshold", float, np.nan)[order], np.nan)
        self.value = np.append(numbers("value", float, 0.0)[order], 0.0)
        here = np.arange(len(keys) + 1, dtype=np.int32)
        self.left, self.right = (np.where(self.inner, place(c), here).astype(np.int32) for c in ("left", "right"))
        lists = nodes["left_values"].combine_chunks()
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
        of = np.repeat(np.argsort(order), sizes)                # where the node of each value lies
        nth = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.values = np.full((len(keys) + 1, max(1, sizes.max(initial=0))), np.nan)
        self.values[of, nth] = lists.flatten().to_numpy(zero_copy_only=False)
        self.roots = np.flatnonzero(keys & 0xFFFFFFFF == 0).astype(np.int32)
        self.width = int(self.feature.max()) + 1
        self.levels = self._levels()

    def _levels(self) -> int:
        here, levels = self.roots, -1
        while len(here):
            levels += 1
            here = here[self.inner[here]]
            here = np.concatenate([self.left[here], self.right[here]])
        return max(levels, 0)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Sum of the leaves that each row reaches. One tree after the other, so its nodes stay in the processor's cache."""
        if x.shape[1] < self.width:
            raise ValueError(f"vectors of {x.shape[1]} numbers, but the trees ask for {self.width}")
        cells, starts, total = x.ravel(), np.arange(len(x)) * x.shape[1], np.zeros(len(x))
        for root in self.roots:
            at = np.full(len(x), root, np.int32)
            for _ in range(self.levels):
                v = cells[starts + self.feature[at]]
                left = v <= self.threshold[at]
                for j in range(self.values.shape[1]):
                    left |= v == self.values[at, j]
                at = np.where(left, self.left[at], self.right[at])
            total += self.value[at]
        return total


def _trees(nodes: DataFrame) -> _Trees:
    return _Trees(nodes.select("tree", "node", "feature", "threshold", "left_values", "left", "right", "value").toArrow())


def score_nodes(vectors: DataFrame, nodes: DataFrame, key: str = "customer_id") -> DataFrame:
    """(key, score) with the sum of the leaves that a row of (key, x array<double>) reaches.

    Every row walks all trees inside its task: the nodes, bounded by the settings of the model, go to the tasks as arrays.
    A step by a join with the nodes would carry a row per customer and tree through every level. Repeated keys are summed:
    pass one row per key.
    """
    trees = _trees(nodes)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x")
            if len(x):
                known = x.is_valid().to_numpy(zero_copy_only=False)     # a missing vector goes right, as a missing value does
                cells = x.flatten().to_numpy(zero_copy_only=False).reshape(known.sum(), -1) if known.any() else np.empty((0, trees.width))
                rows = np.full((len(x), cells.shape[1]), np.nan)
                rows[known] = cells
                yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(trees.scores(rows))], names=[key, "score"])

    schema = StructType([vectors.schema[key], StructField("score", DoubleType())])
    return vectors.select(key, "x").mapInArrow(walk, schema).groupBy(key).agg(F.sum("score").alias("score"))


def levels_of(nodes: DataFrame) -> int:
    """Steps from a root to the deepest leaf."""
    return _trees(nodes).levels


def score_weights(vectors: DataFrame, weights: DataFrame, key: str = "customer_id") -> DataFrame:
    """(key, score): the linear score of one target, or the difference of the last two targets of a net (its log odds).

    A layer's weights become one array per target; a row's layers are computed in place, without a shuffle.
    """
    layers = weights.groupBy("layer", "target").agg(
        F.transform(F.array_sort(F.collect_list(F.when(F.col("source") >= 0, F.struct("source", "weight")))),
                    lambda s: s["weight"]).alias("w"),
        F.max(F.when(F.col("source") < 0, F.col("weight"))).alias("bias"))
    layers = layers.groupBy("layer").agg(F.array_sort(F.collect_list(F.struct("target", "w", "bias"))).alias("units"))
    layers = written_table(vectors.sparkSession, layers)
    n_layers = layers.count()
    out = vectors.select(key, F.col("x").alias("a0"))
    for k in range(n_layers):
        units = F.broadcast(layers.where(F.col("layer") == k).select(F.col("units").alias(f"u{k}")))     # one row
        out = out.join(units)
        z = F.transform(f"u{k}", lambda u: F.aggregate(
            F.zip_with(u["w"], F.col(f"a{k}"), lambda w, a: w * a), u["bias"], lambda s, x: s + x))
        out = out.select(key, (z if k == n_layers - 1 else F.transform(z, lambda v: 1 / (1 + F.exp(-v)))).alias(f"a{k + 1}"))
    top = F.col(f"a{n_layers}")
    return out.select(key, F.when(F.size(top) == 1, top[0]).otherwise(top[1] - top[0]).alias("score"))


def probability(model: PipelineModel, score: Column) -> Column:
    """Churn probability of a table score: a forest's votes are one, boosted trees double the log odds."""
    clf = model.stages[-1]
    if isinstance(clf, RandomForestClassificationModel):
        return score
    return 1 / (1 + F.exp(-(2 * score if isinstance(clf, GBTClassificationModel) else score)))


def score_from_tables(name: str, model: PipelineModel, rows: DataFrame, key: str = "customer_id") -> DataFrame:
    """(key, model_name, p_table): rows that went through `as_training`, scored from the model's exported table."""
    spark = rows.sparkSession
    vectors = PipelineModel(model.stages[:-1]).transform(rows).select(key, vector_to_array("features").alias("x"))
    scored = score_nodes(vectors, node_table(name, model, spark), key) if is_trees(model) else \
        score_weights(vectors, weight_table(name, model, spark), key)
    return scored.select(key, F.lit(name).alias("model_name"), probability(model, F.col("score")).alias("p_table"))

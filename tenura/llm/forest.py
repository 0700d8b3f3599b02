"""N-gram Jaccard join by a MinHash LSH forest, with exact verification.

Every distinct shingle set has one label in each of `trees` tries: an ordered signature of one-byte values. A set
first matches whole labels. Level by level its matched prefixes are shortened, tree by tree, until the recall
expected for a partner at the threshold reaches the target; prefixes that a crowd of sets shares stay long as
long as other trees can make up for them. Two sets are candidates if one of them has matched the other's label.
Within a run of equal prefixes a signature estimate far below the threshold rules pairs out, what is left is
clustered, and inside each cluster all pairs are verified on the exact shingle sets. Pairs never become rows:
tasks return link counts and the few edges that connect what they found.
"""

import math

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.llm.common import Groups, blocks, by_task, text_column, worker_table
from tenura.llm.graph import components
from tenura.session import written_table


@dataclass(frozen=True)
class Forest:
    """`trees` tries (at most 63) over labels of `depth` values (at most 8); `words` per shingle; `threshold` on
    Jaccard. A prefix that more than `crowd` sets share is shortened to last, whatever `crowd` is the recall is met."""

    words: int = 5
    threshold: float = 0.8
    trees: int = 24
    depth: int = 8
    recall: float = 0.999
    crowd: int = 256

    def missed(self, depths: list[int]) -> float:
        """Share of partners at the threshold that prefixes of these lengths, one in each tree, do not match."""
        return math.prod(1 - self.threshold ** d for d in depths)

    def widened(self, level: int) -> float:
        """What shortening one prefix from level + 1 to level leaves of the missed share."""
        return (1 - self.threshold ** level) / (1 - self.threshold ** (level + 1))

    def ordinary(self) -> list[int]:
        """Prefix lengths of a set that meets no crowd."""
        depths = [self.depth] * self.trees
        for level in range(self.depth - 1, 0, -1):
            for tree in range(self.trees):
                if self.missed(depths) <= self.spare():
                    return depths
                depths[tree] = level
        return depths

    def spare(self) -> float:
        return (1 - self.recall) * (1 + 1e-9)

    def prefix(self) -> int:
        """The longest prefix that reaches the target recall if all trees match it: 1 - (1 - t^d)^trees."""
        d = self.depth
        while d > 1 and 1 - (1 - self.threshold ** d) ** self.trees < self.recall:
            d -= 1
        return d

    def floor(self) -> float:
        """Signature agreement that a pair at the threshold misses only beyond 4.5 standard deviations."""
        n, t = self.trees * self.depth, self.threshold
        return t - 4.5 * (t * (1 - t) / n) ** 0.5

    def permutations(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.RandomState(20240229)
        n = self.trees * self.depth
        return tuple(rng.randint(0, 1 << 62, n, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (shift, multiply), so that sums of word hashes spread evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __init__(self, room: int = 250_000):
        from xxhash import xxh64_intdigest

        self.digest, self.room = xxh64_intdigest, room

    def __missing__(self, word: str) -> int:
        if len(self) >= self.room:
            self.clear()
        h = self.digest(word.encode("utf-8", "surrogatepass"))
        if len(word) <= 64:
            self[word] = h
        return h


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of `size` words (lower case, apart at white space). A text
    of fewer words is one shingle of all of them; a text without words has none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(worker_table(WordHashes, WordHashes).__getitem__, words), np.uint64, len(words))
    n = min(size, len(words))
    out = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[k:len(h) - n + 1 + k])
    return np.unique(out)


def signature(s: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least value of each hash function over the set, in blocks so that long texts stay small."""
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(s), 4096):
        part = s[k:k + 4096]
        v = part[None, :] * a[:, None]
        v += b[:, None]
        np.minimum(low, v.min(axis=1), out=low)
    return low


SIGNED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text_key", T.LongType()), T.StructField("n_shingles", T.LongType()),
    T.StructField("node", T.BinaryType()), T.StructField("labels", T.ArrayType(T.LongType()))])


def _sign(forest: Forest, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = forest.permutations()
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.binary()),
                        ("labels", pa.list_(pa.int64()))])
    label = np.zeros((forest.trees, 8), np.uint8)
    for batch in batches:
        rows = []
        for doc_id, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            s = shingles(text.as_py(), forest.words)
            if not len(s):
                rows.append((doc_id, key, 0, None, None))
                continue
            node = np.array([mixed(s * np.uint64(3)).sum(), mixed(s + np.uint64(77)).sum()], np.uint64).tobytes()
            low = mixed(signature(s, a, b)).reshape(forest.trees, forest.depth)
            label[:, :forest.depth] = low & np.uint64(255)
            rows.append((doc_id, key, len(s), node, label.view(">i8").ravel().tolist()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def sign(docs: DataFrame, forest: Forest) -> DataFrame:
    """One row per row of docs: its id, a hash of its text, the 128-bit digest of its shingle set (`node`), and its
    labels: one number for each tree, whose bytes from the highest on are the values of the ordered signature."""
    text = text_column(docs)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    return rows.mapInArrow(lambda b: _sign(forest, b), SIGNED)


def _prefix(label: str, level: str | int) -> Column:
    return F.expr(f"shiftrightunsigned({label}, 64 - 8 * {level})")


class Crowds:
    """Prefixes that more than `Forest.crowd` sets share, level by level.

    A prefix can be a crowd only if the shorter prefixes of it are. So all sets are counted at one level, the first
    at which chance alone makes no crowds; longer prefixes are counted among the sets below the crowds of that level,
    shorter ones are added up from its counts. Only that one count is shuffled for every set and tree.
    """

    def __init__(self, bare: DataFrame, forest: Forest):
        self.spark, self.forest = bare.sparkSession, forest
        n, self.first = bare.count(), 1
        while self.first < forest.depth - 1 and 4 * n > forest.crowd * 256 ** self.first:
            self.first += 1
        at = bare.select(F.posexplode("labels").alias("tree", "label"))
        here = at.withColumn("prefix", _prefix("label", self.first))
        self.counts = written_table(self.spark, here.groupBy("tree", "prefix").agg(F.count("*").alias("n")))
        crowds = self.counts.where(F.col("n") > forest.crowd).select("tree", "prefix")
        below = _of_crowds(here, crowds).groupBy("tree", "label").agg(F.count("*").alias("n"))
        self.leaves = written_table(self.spark, below)

    def at(self, level: int) -> DataFrame:
        """tree, prefix of the crowds at this level, a written table."""
        if level < self.first:
            prefix = F.expr(f"shiftrightunsigned(prefix, {8 * (self.first - level)})")
            found = self.counts.groupBy("tree", prefix.alias("prefix")).agg(F.sum("n").alias("n"))
        else:
            found = self.leaves.groupBy("tree", _prefix("label", level).alias("prefix")).agg(F.sum("n").alias("n"))
        return written_table(self.spark, found.where(F.col("n") > self.forest.crowd).select("tree", "prefix"))


def _of_crowds(rows: DataFrame, crowds: DataFrame) -> DataFrame:
    """Rows whose (tree, prefix) is a crowd; a bitmap keeps most others from being shuffled."""
    key = F.xxhash64("tree", "prefix").alias("key")
    return _sieve(rows.select("*", key), "key", crowds.select(key)).drop("key").join(crowds, ["tree", "prefix"])


def match(bare: DataFrame, forest: Forest) -> DataFrame:
    """node, labels, depths: the length of the prefix that each set matches in each tree.

    All start at whole labels. At each level those whose recall is not met yet shorten their prefixes to it, tree by
    tree and no more trees than needed, but not in trees where a crowd shares that prefix. A set for which only
    crowds are left takes `Forest.prefix()` everywhere, which meets the target by itself. How far a set goes depends on
    nothing about one partner: a partner changes the size of a run by one, and only sizes beyond `crowd` count.
    Every level is a written table; rows are the sets still open, and the crowds are few against the labels.
    """
    spark = bare.sparkSession
    crowds = Crowds(bare, forest)
    whole = [forest.depth] * forest.trees
    rows = bare.select("node", "labels", F.array(*map(F.lit, whole)).alias("depths"), F.lit(forest.missed(whole)).alias("missed"))
    done = []
    for level in range(forest.depth - 1, 0, -1):
        at = rows.select("node", F.posexplode("labels").alias("tree", "label"))
        at = _of_crowds(at.select("node", "tree", _prefix("label", level).alias("prefix")), crowds.at(level))
        crowded = written_table(spark, at.groupBy("node").agg(F.bit_or(F.expr("shiftleft(1L, tree)")).alias("crowded")))
        left = F.log(F.lit(forest.spare()) / F.col("missed")) / math.log(forest.widened(level))
        rows = rows.join(crowded, "node", "left").withColumn("free", F.expr(
            f"filter(sequence(0, {forest.trees - 1}), i -> (coalesce(crowded, 0L) & shiftleft(1L, i)) = 0)"))
        rows = rows.withColumn("taken", F.slice("free", F.lit(1), F.greatest(F.lit(0), F.ceil(left)).cast("int")))
        rows = rows.select(
            "node", "labels", F.expr(f"transform(depths, (d, i) -> if(array_contains(taken, i), {level}, d))").alias("depths"),
            (F.col("missed") * F.pow(F.lit(forest.widened(level)), F.size("taken"))).alias("missed"),
            (F.size("free") > 0).alias("more"))
        rows = written_table(spark, rows)
        met = F.col("missed") <= forest.spare() * (1 + 1e-9)
        done.append(rows.where(met).select("node", "labels", "depths"))
        done.append(_all_at_prefix(rows.where(~met & ~F.col("more")), forest))
        rows = rows.where(~met & F.col("more")).drop("more")
        if rows.isEmpty():
            return reduce(DataFrame.union, done)
    return reduce(DataFrame.union, [*done, _all_at_prefix(rows, forest)])


def _all_at_prefix(rows: DataFrame, forest: Forest) -> DataFrame:
    return rows.select("node", "labels", F.expr(f"transform(depths, d -> least(d, {forest.prefix()}))").alias("depths"))


def runs(matched: DataFrame, forest: Forest) -> DataFrame:
    """run, node, active: the sets that share a matched prefix. Active ones matched it themselves; the others have longer
    matches in that tree but lie below the prefix.

    Only sets that met crowds match prefixes shorter than others do, so others look for runs of theirs alone.
    """
    special = F.col("depths") != F.array(*map(F.lit, forest.ordinary()))
    at = matched.select("node", special.alias("special"), F.posexplode(F.arrays_zip("labels", "depths")).alias("tree", "at"))
    at = at.select("node", "special", "tree", F.col("at.labels").alias("label"), F.col("at.depths").alias("depth"))
    own = at.select("node", "special", F.xxhash64("tree", "depth", _prefix("label", "depth")).alias("run"), F.lit(True).alias("active"))
    above = at.where("depth > 1").select("node", "tree", "label", F.explode(F.expr("sequence(1, depth - 1)")).alias("level"))
    above = above.select("node", F.xxhash64("tree", "level", _prefix("label", "level")).alias("run"), F.lit(False).alias("active"))
    above = _sieve(above, "run", own.where("special").select("run"))
    return own.select("run", "node", "active").unionByName(above)


def _edge_batch(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], names=["a", "b"])


def _close(forest: Forest, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of trie runs to the edges that connect members, one of them active, whose labels agree enough."""
    least = (forest.floor() + (1 - forest.floor()) / 256) * forest.trees * forest.depth
    width = forest.trees * forest.depth
    out: list[tuple[bytes, bytes]] = []
    for run in by_task(["run", "block_i", "block_j"], batches):
        n = run.num_rows
        if n < 2:
            continue
        nodes = run.column("node").to_pylist()
        side = run.column("side").to_numpy()
        cross = run.column("block_i")[0].as_py() != run.column("block_j")[0].as_py()
        active = run.column("active").to_numpy()
        labels = run.column("labels").combine_chunks().flatten().to_numpy().astype(">i8")
        sketch = labels.view(np.uint8).reshape(n, forest.trees, 8)[:, :, :forest.depth].reshape(n, width)
        groups = Groups(n)
        for k in range(n - 1):
            rest = slice(k + 1, n)
            near = (sketch[rest] == sketch[k]).sum(axis=1) >= least
            if cross:
                near &= side[rest] != side[k]
            if not active[k]:
                near &= active[rest]
            hits = np.flatnonzero(near) + k + 1
            out += [(nodes[x], nodes[y]) for x, y in groups.join(np.full(len(hits), k), hits)]
        if len(out) > 20_000:
            yield _edge_batch(out)
            out = []
    if out:
        yield _edge_batch(out)


def _overlap(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of incidence columns in strips."""
    n = len(sets)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    first = np.r_[True, values[1:] != values[:-1]]
    column = np.cumsum(first) - 1
    shared = np.bincount(column)[column] > 1  # a shingle of one text alone meets nothing
    owner, column = owner[shared], column[shared]
    common = np.zeros((n, n), np.float64)
    if not len(column):
        return common
    column = np.cumsum(np.r_[True, column[1:] != column[:-1]]) - 1
    for c in range(0, int(column[-1]) + 1, width):
        lo, hi = np.searchsorted(column, [c, c + width])
        strip = np.zeros((n, width), np.float32)
        strip[owner[lo:hi], column[lo:hi] - c] = 1
        common += strip @ strip.T
    return common


LINKS = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType()), T.StructField("n_links", T.LongType())])


def _verify(forest: Forest, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of clusters to link counts (b null) and connecting edges (n_links null) of verified pairs."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("n_links", pa.int64())])
    rows: list[tuple] = []
    for run in by_task(["cluster", "block_i", "block_j"], batches):
        n = run.num_rows
        if n < 2:
            continue
        nodes, copies = run.column("node").to_pylist(), run.column("copies").to_numpy()
        sets = [shingles(x.as_py(), forest.words) for x in run.column("text")]
        size = np.array([len(s) for s in sets], np.float64)
        common = _overlap(sets)
        linked = common >= forest.threshold * (size[:, None] + size[None, :] - common) - 1e-9
        if run.column("block_i")[0].as_py() != run.column("block_j")[0].as_py():
            side = run.column("side").to_numpy()
            linked &= side[:, None] != side[None, :]
        np.fill_diagonal(linked, False)
        counts = linked @ copies
        rows += [(nodes[k], None, int(counts[k])) for k in np.flatnonzero(counts).tolist()]
        x, y = np.nonzero(np.triu(linked))
        rows += [(nodes[i], nodes[j], None) for i, j in Groups(n).join(x, y)]
        if len(rows) > 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def jaccard_join(docs: DataFrame, forest: Forest = Forest(), cell_rows: int = 1_000, cell_shingles: int = 4_000_000) -> DataFrame:
    """One row per distinct (doc_id, text) of `docs`: doc_id, text_key (xxhash64 of the text), n_shingles, n_copies,
    n_links, class_id, kept.

    Two documents are linked if the Jaccard similarity of their sets of word shingles is at least the
    threshold. `n_links` counts the documents linked to it directly, copies included; `n_copies` those with
    the same shingle set, itself included; `class_id` is the smallest doc_id that links reach; `kept` is true
    for one document of each class, that with the smallest doc_id (ties: smallest text_key).

    A text without words links with nothing and is a class of its own; null text counts as empty. Rows that
    repeat an id and a text are one document; rows that repeat an id with different texts are documents of
    their own. A null doc_id sorts before all others. Other columns are not read.

    Equal shingle sets are reduced to one node first (with partial sums, so copies of one text in a third of all
    rows are harmless). Runs and clusters with many nodes are dealt to block grids, so no task holds more than
    two blocks and nothing is capped.
    """
    spark = docs.sparkSession
    signed = written_table(spark, sign(docs, forest))
    texts = signed.where("node IS NOT NULL")
    # doc_first: which document stands for a node; the least in order of (doc_id, text_key), null first.
    order = F.struct(F.col("doc_id").isNotNull().alias("o"), "doc_id", "text_key")
    nodes = (
        texts.select("node", "doc_id", "text_key").distinct().groupBy("node")
        .agg(F.min(order).alias("who"), F.count("*").alias("copies"))
    )
    bare = texts.groupBy("node").agg(F.first("labels").alias("labels"), F.first("n_shingles").alias("n_shingles"))
    bare = written_table(spark, bare)

    # Runs of the tries: nodes below a prefix that one of them matches.
    placed = runs(match(bare, forest), forest)
    size = placed.groupBy("run").agg(F.count("*").alias("n"), F.bool_or("active").alias("opened")).where("n > 1 AND opened")
    size = written_table(spark, size.select("run", F.ceil(F.col("n") / F.lit(2 * cell_rows)).cast("int").alias("n_blocks")))
    members = _sieve(placed, "run", size.select("run")).join(size, "run")
    members = members.join(bare.select("node", "labels"), "node")
    cells = blocks(members, "node")
    keys = ["run", "block_i", "block_j"]
    cells = cells.repartition(*keys).sortWithinPartitions(*keys)
    near = cells.select(*keys, "side", "node", "active", "labels").mapInArrow(lambda b: _close(forest, b), "a binary, b binary")
    clusters = components(near).select("node", F.col("component").alias("cluster"))

    # Exact verification of all pairs in each cluster.
    inside = nodes.join(clusters, "node").join(bare.select("node", "n_shingles"), "node")
    inside = written_table(spark, inside)
    grid = inside.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    grid = grid.select("cluster", F.greatest(F.ceil(F.col("n") / cell_rows), F.ceil(F.col("s") / cell_shingles)).cast("int").alias("n_blocks"))
    inside = inside.select("node", "cluster", "copies", F.col("who.doc_id").alias("w_doc"), F.col("who.text_key").alias("w_key"))
    texts_of = docs.select(docs["doc_id"].cast("long").alias("t_doc"), text_column(docs).alias("text"))
    texts_of = texts_of.withColumn("t_key", F.xxhash64("text"))
    texts_of = _sieve(texts_of, "t_key", inside.select("w_key"))
    inside = inside.join(texts_of, inside["w_doc"].eqNullSafe(texts_of["t_doc"]) & (inside["w_key"] == texts_of["t_key"]))
    inside = inside.select("node", "cluster", "copies", "text").dropDuplicates(["node"])
    cells = blocks(inside.join(grid, "cluster"), "node")
    keys = ["cluster", "block_i", "block_j"]
    cells = cells.repartition(*keys).sortWithinPartitions(*keys)
    found = written_table(spark, cells.select(*keys, "side", "node", "copies", "text").mapInArrow(lambda b: _verify(forest, b), LINKS))
    links = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n_links").alias("linked"))
    parts = components(found.where("b IS NOT NULL").select("a", "b"))

    classes = nodes.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = classes.groupBy("component").agg(F.min("who").alias("first"))
    classes = classes.join(first, "component").join(links, "node", "left").select(
        F.col("node").alias("class_node"), "first", "copies", F.coalesce("linked", F.lit(0)).alias("linked"))
    rows = signed.select("doc_id", "text_key", "n_shingles", "node").distinct()
    rows = rows.join(classes, rows["node"] == classes["class_node"], "left")
    alone = F.col("class_node").isNull()
    return rows.select(
        "doc_id", "text_key", "n_shingles", F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
        F.when(alone, 0).otherwise(F.col("linked") + F.col("copies") - 1).cast("long").alias("n_links"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key")))).alias("kept"))


SIEVE_WORDS = 1 << 18


def _sieve(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows whose hash may be among the wanted ones, so that few others are shuffled to meet them.

    A bitmap of SIEVE_WORDS x 64 bits, as a table of its words that are not empty: at most SIEVE_WORDS rows
    whatever the input, hence the broadcast. It lets every wanted row pass; the join after it decides.
    """
    def word(name):
        return F.pmod(F.shiftrightunsigned(name, 6), F.lit(SIEVE_WORDS)).cast("int")

    def bit(name):
        return F.expr(f"shiftleft(1L, cast(pmod({name}, 64) AS int))")

    hashed = wanted.columns[0]
    bitmap = wanted.groupBy(word(hashed).alias("sieve_word")).agg(F.bit_or(bit(hashed)).alias("sieve_bits"))
    return rows.join(F.broadcast(bitmap), word(key) == F.col("sieve_word")) \
        .where(F.col("sieve_bits").bitwiseAND(bit(key)) != 0).drop("sieve_word", "sieve_bits")


def keep_one(docs: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """The rows of `docs` without those whose class has another document that stays; columns as they are.
    Rows that repeat an id and a text stay or go together."""
    gone = jaccard_join(docs, forest).where(~F.col("kept")).select(F.col("doc_id").alias("gone_d"), F.col("text_key").alias("gone_t"))
    row = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs["doc_id"].cast("long").alias("d"),
                      F.xxhash64(text_column(docs)).alias("t"))
    return row.join(gone, row["d"].eqNullSafe(gone["gone_d"]) & (row["t"] == gone["gone_t"]), "left_anti").select("row.*")

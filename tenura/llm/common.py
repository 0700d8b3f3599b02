"""Helpers shared by the operators of this package."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_task(keys: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys from batches sorted by those keys, one table for each run.

    Holds one run at a time, so callers bound the size of a run by how they deal rows to keys.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(n, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        if held and tuple(c[0] for c in columns) != last:
            yield pa.Table.from_batches(held)
            held = []
        starts = [0, *np.flatnonzero(new).tolist()]
        for s, e in zip(starts, [*starts[1:], n]):
            if s:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(s, e - s))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


def text_column(df: DataFrame, name: str = "text") -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(df[name].cast("string"), F.lit(""))


class Groups:
    """Union-find over 0..n-1 inside one task."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def join(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        """Unite the pairs; returns those that connected something new, fewer than n in all."""
        new = []
        for x, y in zip(a.tolist(), b.tolist()):
            p, q = self.find(x), self.find(y)
            if p != q:
                self.parent[max(p, q)] = min(p, q)
                new.append((x, y))
        return new


def blocks(members: DataFrame, member: str) -> DataFrame:
    """Deal the members of groups to cells (block_i <= block_j) of their group's block grid.

    `members` has the number of blocks of its group in `n_blocks`. A member of block b goes to every cell
    of row or column b, so each pair of members meets in exactly one cell, and no cell holds more than two
    blocks. `side` is 0 for a row of block_i, 1 for block_j.
    """
    dealt = members.withColumn("own_block", F.pmod(F.xxhash64(member, F.lit(17)), F.col("n_blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("other_block")
    return (
        dealt.select("*", other)
        .withColumn("block_i", F.least("own_block", "other_block"))
        .withColumn("block_j", F.greatest("own_block", "other_block"))
        .withColumn("side", (F.col("own_block") > F.col("other_block")).cast("int"))
        .drop("own_block", "other_block", "n_blocks")
    )


_tables: dict = {}


def worker_table(name, make):
    """A table that a Python worker keeps from task to task. Workers outlive stages and serve one operator after another,
    so a worker keeps one table at a time: asking for another one lets the last one go. No maker: just let it go."""
    if name not in _tables:
        _tables.clear()
        if make is None:
            return None
        _tables[name] = make()
    return _tables[name]


class Recent(dict):
    """Values by key, made when missing. Holds at most `room` of them, in two generations of half that size.

    Keys not seen lately are looked for in the older generation and move over; when the younger one is full it
    becomes the older one. So what occurs often stays, and what occurred once goes. Long keys are not held.
    """

    def __init__(self, make, room: int = 600_000, longest: int = 64):
        super().__init__()
        self.make, self.half, self.longest, self.old = make, room // 2, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            self.hold(key, value)
        return value

    def hold(self, key, value) -> None:
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[key] = value

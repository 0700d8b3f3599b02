"""Helpers for tables of embedding vectors."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.llm.common import Iterator

SEED = 7


def usable(v: Column) -> Column:
    """Not null, not empty, every component there and finite."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(v) > 0) & ~bad, F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array, dtype: str = "<f8") -> np.ndarray:
    """Rows of a binary column, all of one length, as a matrix."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype).reshape(len(rows), -1)


def as_bytes(df: DataFrame, name: str, dtype: str, change=None) -> DataFrame:
    """Replace the array column `name`, all components given, by its bytes; `change` works on each vector."""
    at = df.columns.index(name)
    schema = df.drop(name).schema.add("dim", T.IntegerType()).add(name, T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(at)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int32)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<f8")
            flat = (change(flat) if change else flat).astype(dtype)
            ends = np.cumsum(sizes)
            data = [flat[e - n:e].tobytes() for e, n in zip(ends.tolist(), sizes.tolist())]
            rest = [batch.column(k) for k in range(batch.num_columns) if k != at]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(sizes, pa.int32()), pa.array(data, pa.binary())], names=schema.names)

    return df.mapInArrow(run, schema)


def bounded_sample(df: DataFrame, n_rows: int, limit: int, key: str) -> DataFrame:
    """About `limit` rows, chosen by hash of `key`; all of them if there are no more."""
    if n_rows <= limit:
        return df
    draw = F.pmod(F.xxhash64(key, F.lit(SEED)), F.lit(1_000_000_000))
    return df.where(draw < int(1_000_000_000 * limit / n_rows) + 1)

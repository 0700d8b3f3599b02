"""Registry of named queries and of the DuckDB SQL each one is checked against."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tenura.sources.warehouse import Warehouse

_queries: dict[str, Callable[[Warehouse], DataFrame]] = {}
_oracles: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function Warehouse -> DataFrame under a name, with its check SQL if there is one."""
    def register(fn):
        if name in _queries:
            raise ValueError(f"query {name} is registered twice")
        _queries[name] = fn
        if sql is not None:
            _oracles[name] = sql
        return fn
    return register


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, data_dir: fn(Warehouse.open(spark, data_dir))
    return {name: bind(fn) for name, fn in _queries.items()}


def all_oracles() -> dict[str, str]:
    return dict(_oracles)

"""Connected components by alternating large-star and small-star steps, all in joins and aggregates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.session import written_table


def _kept(edges: DataFrame) -> DataFrame:
    return written_table(edges.sparkSession, edges.where("a != b").distinct())


def _mark(edges: DataFrame) -> tuple:
    """Row count and order-free digest of an edge table, to see when it stops changing."""
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(h), F.sum(F.pmod(h, F.lit(1 << 31)))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected edges (a, b); component is the smallest node.

    Nodes may have any orderable type. Edges with a null end and loops connect nothing. Each step is
    written to the shared folder, so a lost executor costs a re-read. A node with very many edges is
    aggregated map-side for its smallest neighbour and split by the skew join afterwards.
    """
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    edges = _kept(edges.select("a", "b").dropna().select(larger.alias("a"), smaller.alias("b")))
    mark = _mark(edges)
    while mark[0]:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        # Written, so that both sides of the join come from a shuffle and the skew join may split a hot node.
        low = written_table(edges.sparkSession, low)
        star = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        star = star.where("a != b").distinct()
        low = star.groupBy("a").agg(F.min("b").alias("low"))
        star = star.join(low, "a").select(
            F.explode(F.array(F.struct("a", F.col("low").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")).select("e.*")
        edges = _kept(star)
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return ends.union(edges.select("b", "b")).distinct()

"""Connected components of a graph given as a table of edges, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clienttrail.llm.common import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the smallest node it knows."""
    both = _both_ways(edges)
    least = both.groupBy("a").agg(F.min("b").alias("low"))
    least = least.select(F.col("a").alias("node"), F.least("a", "low").alias("low"))
    larger = both.where("b > a")
    return larger.join(least, F.col("a") == F.col("node")).select(
        F.col("b").alias("a"), F.col("low").alias("b")
    ).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands its smaller neighbours, and itself, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("low")).withColumnRenamed("a", "node")
    rest = down.join(least, F.col("a") == F.col("node")).select(
        F.col("b").alias("a"), F.col("low").alias("b")
    )
    own = least.select(F.col("node").alias("a"), F.col("low").alias("b"))
    return rest.unionAll(own).where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of the edges (a, b); root is the component's smallest node.

    Loops and null ends are ignored, repeated and reversed edges count once, no edges give no rows.
    Minima combine before they shuffle and adaptive execution splits the joins at nodes with very many
    edges. Rounds grow with the logarithm of the longest path; each is written to the shared folder.
    """
    edges = edges.select("a", "b").where("a <> b").distinct()
    edges = stored(edges, "edges")
    before = _state(edges)
    while before[0]:
        edges = stored(_small_star(_large_star(edges)), "edges")
        now = _state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        roots.select("node", F.col("node").alias("root"))
    )

"""Connected components of a graph in a DataFrame, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remove, written


def _mark(edges: DataFrame) -> tuple:
    got = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
    return tuple(got)


def _large(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to its smallest one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    own = least.select("a", F.col("m").alias("b"))
    return joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(own).where("a <> b").distinct()


def written_components(edges: DataFrame) -> tuple[DataFrame, str]:
    """(a, b) -> (node, label), and the path of that table: the label is the smallest node that can be reached.

    Nodes without edges have no row. Loops and repeated edges change nothing. Minima are partial sums and
    neighbours are joined, not gathered, so a node with very many neighbours is never in one task.
    """
    spark = edges.sparkSession
    edges, path = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        edges, after_path = written(_small(_large(edges)), "edges")
        remove(spark, path)
        path, after = after_path, _mark(edges)
        if after == mark:
            break
        mark = after
    own = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("label"))
    out = written(edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(own), "components")
    remove(spark, path)
    return out


def components(edges: DataFrame) -> DataFrame:
    """The same without the path, for callers that leave the table until the driver ends."""
    return written_components(edges)[0]

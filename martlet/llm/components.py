"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.session import scratch_path


def _stored(edges: DataFrame, name: str) -> DataFrame:
    """``edges`` written to the shared folder and read back, so that no iteration drags the earlier ones along."""
    path = scratch_path(edges.sparkSession, name)
    edges.write.parquet(path)
    return edges.sparkSession.read.parquet(path)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hangs its larger neighbours on the smallest node it sees."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Stored first, so that the join has two plain sides and Spark can split the rows of a frequent node.
    smallest = _stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "smallest")
    return both.filter("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hangs its smaller neighbours, and itself, on the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b")
    smallest = down.groupBy("a").agg(F.min("b").alias("m"))
    rehung = down.join(smallest, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rehung.unionByName(smallest.select("a", F.col("m").alias("b")))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node on an edge.

    Alternates the two star operations until the edges form stars. Each iteration is two
    aggregations with map-side minima and joins against one row per node, so a node with a great
    many neighbours is a skewed join side that Spark can split, never a group in one task.
    """
    edges = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct()
    mark, edges = None, _stored(edges, "components")
    while True:
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark or seen[0] == 0:
            break
        mark = seen
        edges = _stored(_small_star(_large_star(edges)).distinct(), "components")
    stars = edges.groupBy(F.greatest("a", "b").alias("node")).agg(F.min(F.least("a", "b")).alias("component"))
    roots = stars.select(F.col("component").alias("node"), "component").distinct()
    return stars.unionByName(roots)

"""Connected components of a link table, on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _mark(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(links: DataFrame, free: bool = True) -> DataFrame:
    """(node, component) of every node in ``links`` (a long, b long);
    ``component`` is the smallest node that can be reached.

    Alternates the large-star and small-star steps: each hands the links of a
    node to its smallest neighbour, so chains halve and a finished component is
    a star around its smallest node.  A step is a grouped minimum (partial
    first) and a join on the node that Spark may split when skewed; every round
    is written to the shared folder (``free``: see ``written``), and the driver sees two numbers a round.
    Null ends and self-links are left out; an empty table gives an empty result.
    """
    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .filter("a != b").distinct(), "links", free)
    seen = _mark(edges)
    while seen[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = (both.filter("b > a").join(least, "a")              # larger neighbours go to the smallest
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least.select("a", F.col("m").alias("b"))).filter("a != b").distinct())
        edges = written(small, "links", free)
        now = _mark(edges)
        if now == seen:
            break
        seen = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

"""Connected components of an edge table by alternating large and small stars (Kiveris et al.)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlake.llm.common import drop_stage, stage


def _stars(edges: DataFrame) -> DataFrame:
    """Large star, then small star: every node is led to smaller ones."""
    both = edges.union(edges.select("b", "a"))
    least = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "star")
    large = (
        both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )
    large = stage(large, "large-star")
    # Here every edge leads from the larger node a to the smaller b.
    drop_stage(least)
    least = stage(large.groupBy("a").agg(F.min("b").alias("m")), "star")
    small = (
        large.join(least, "a")
        .select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        .where("a <> b")
        .distinct()
    )
    small = stage(small, "small-star")
    drop_stage(least)
    drop_stage(large)
    return small


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge; the root is the smallest node of its component.

    ``edges`` has two columns of one orderable type. Edges with a null end and loops are left out,
    repeated edges count once; no edges give no rows. Each round writes the edges to the shared
    folder. The rounds grow with the logarithm of the longest path. A node with very many edges
    is met as a minimum taken before the shuffle and a join that Spark may split.
    """
    a, b = edges.columns
    edges = stage(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .distinct(),
        "edges",
    )
    seen = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if not now[0] or now == seen:
            break
        seen, old = now, edges
        edges = _stars(edges)
        drop_stage(old)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select("b", "b").distinct()
    )

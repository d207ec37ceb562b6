"""Connected components of a graph given as edges: rounds of large-star and small-star, each written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortframe.session import barrier


def _with_least(e: DataFrame) -> DataFrame:
    """Edges (u, v) with the least neighbour of u, u itself included. The minimum combines before the shuffle."""
    least = e.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("u2"), F.least("m", F.col("u")).alias("m"))
    return e.join(least, F.col("u") == F.col("u2")).select("u", "v", "m")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, component`` for each id of an edge; the component is the smallest id that can be reached."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = barrier(e, "edges")
    while not _stars(e):
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        # Here each edge leads to a smaller id, so the least neighbour is below u.
        small = _with_least(large.distinct())
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(small.select("u", F.col("m").alias("v")))
        e = barrier(small.where("u <> v").distinct(), "edges")
    nodes = e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return nodes.unionAll(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _stars(e: DataFrame) -> bool:
    """Whether each u has one edge and no v is a u: then the edges lead straight to the smallest ids."""
    one, no = F.lit(1), F.lit(0)
    ends = e.select(F.col("u").alias("id"), one.alias("out"), no.alias("in")).unionAll(e.select(F.col("v").alias("id"), no, one))
    sums = ends.groupBy("id").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
    return sums.where("out > 1 or (out = 1 and in = 1)").isEmpty()

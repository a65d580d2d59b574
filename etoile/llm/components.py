"""Connected components of a distributed edge list: alternating large-star and small-star steps until nothing changes.

Every step is a grouped minimum (combined map-side) and a join; edges never visit the driver. A node with very many
neighbours is a skewed join key, which Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etoile.session import dematerialize, materialize


ROWS = 200_000      # rows of short columns that are worth a task


def sized(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in as many partitions as ``rows`` (at most) are worth, for a short table that is written."""
    return df.coalesce(rows // ROWS + 1)


def _stars(edges: DataFrame, rows: int) -> DataFrame:
    """One large-star step, then one small-star step, over edges (u, v)."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    large = materialize(sized(large, rows), "large")
    down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = materialize(sized(moved.union(least.select("u", F.col("m").alias("v"))).distinct(), rows), "small")
    dematerialize(large)
    return out


def _done(edges: DataFrame) -> bool:
    """Whether the edges are stars: every u has one v, and no node is both."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).union(edges.select("v", F.lit(0)))
    both = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return both.where("ups > 1 or (ups = 1 and least = 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """Edges (u, v) of longs -> (node, label) of every node that has an edge; the label is the smallest node."""
    rows = 4 * edges.count()                                   # no step has more edges than both directions of the first
    now = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = materialize(sized(now, rows), "edges")
    while not _done(now):
        new = _stars(now, rows)
        dematerialize(now)
        now = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(now.select("v", "v").distinct())

"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .base import written


def _least_neighbour(pairs: DataFrame) -> DataFrame:
    """``a, m``, written: a join with it can then split the rows of a hub."""
    return written(pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "cc-least")


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges(a, b)``; label: least node of its component.

    Alternating large-star and small-star rounds: every node links its larger
    (then its smaller) neighbours to its least neighbour, until nothing
    changes. A round is two groupings with partial aggregation and two joins
    whose right side has one row per node, so a hub's rows can be split; it
    is written to the shared folder. Rounds grow with the logarithm of the
    longest chain; only a row count and a checksum reach the driver.
    """
    def least(pairs: DataFrame) -> DataFrame:
        mins = _least_neighbour(pairs)
        out = pairs.join(mins, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = out.unionByName(mins.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def mark(df: DataFrame) -> tuple:
        r = df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).head()
        return r[0], r[1]

    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .where("a <> b").distinct(), "cc-edges")
    seen = mark(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        mins = _least_neighbour(both)
        large = both.join(mins, "a").where("b > a") \
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        now = written(least(written(large, "cc-large")), "cc-round")
        mark_now = mark(now)
        if mark_now == seen:
            break
        seen = mark_now
    labels = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return labels.unionByName(roots)

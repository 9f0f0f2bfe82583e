"""First-n, per-group first-n and sort-then-limit.

A group is cut to its first n in every task before the one exchange (Catalyst puts a
partial ``WindowGroupLimit`` there, up to
``spark.sql.optimizer.windowGroupLimitThreshold``), so the last task of a hot group
sees at most ``n`` rows from every task, however large the group: 10 million rows of
100,000 tasks for n = 100. Global ``orderBy().limit(n)`` plans as
``TakeOrderedAndProject``: a top-n per partition, then a merge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_n(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """First ``n`` rows in arrival order (``order`` = the arrival sequence)."""
    return df.orderBy(*order).limit(n)


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                    n: int, rank_col: str | None = None) -> DataFrame:
    """At most ``n`` rows per group, the first ones in ``order`` (make it unique)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn("_tn_rank", F.row_number().over(w)).where(F.col("_tn_rank") <= n)
    return out.withColumnRenamed("_tn_rank", rank_col) if rank_col else out.drop("_tn_rank")


def group_first_n(df: DataFrame, keys: Sequence[str], n: int,
                  seq: Sequence[str | Column]) -> DataFrame:
    """First ``n`` members of each group in arrival order ``seq``."""
    return top_n_per_group(df, keys, seq, n)


def group_sorted_first(df: DataFrame, keys: Sequence[str], sort: Sequence[str | Column],
                       n: int = 1) -> DataFrame:
    """Sort inside each group by ``sort`` and keep the first ``n``."""
    return top_n_per_group(df, keys, sort, n)


def sort_limit(df: DataFrame, order: Sequence[Column], n: int, global_sort: bool = True
               ) -> DataFrame:
    """Multi-key sort with mixed directions, then the first ``n``.

    ``global_sort=False`` keeps the per-partition flavour: sort inside each
    partition only (``sortWithinPartitions``), no shuffle, no limit.
    """
    if global_sort:
        return df.orderBy(*order).limit(n)
    return df.sortWithinPartitions(*order)

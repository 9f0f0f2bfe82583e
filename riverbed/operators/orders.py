"""Order amount per time window (the order program is only a stub; the
query is inferred from its name and its data: amounts per creation-time
window)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .windows import window_agg


def order_amount(df: DataFrame, ts: str, amount: str | Column, size: str = "1 day"
                 ) -> DataFrame:
    """``window_start, window_end, n_orders, amount`` per tumbling window."""
    a = F.col(amount) if isinstance(amount, str) else amount
    return window_agg(df, ts, size, [F.count(F.lit(1)).alias("n_orders"),
                                     F.sum(a).alias("amount")])

"""Join two inputs on a key inside the same tumbling window (batch form).

Rows meet only when they share the key *and* the window; the output is
every such pair (the window join's definition), with the window bounds.
The join key is ``(key, window start)``, so the work splits by window as
well as by key; AQE splits a skewed (key, window) partition further.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.timefns import duration_micros, floor_to, from_micros, to_micros


def window_join(left: DataFrame, right: DataFrame, key: str, ts: str, size: str
                ) -> DataFrame:
    """``key, window_start, window_end, <left values>, <right values>``.

    Both inputs carry ``key`` and ``ts``; their other columns must differ.
    """
    step = duration_micros(size)
    lv = [c for c in left.columns if c not in (key, ts)]
    rv = [c for c in right.columns if c not in (key, ts)]
    w = lambda df: floor_to(to_micros(df[ts]), step)
    lw = left.select(key, w(left).alias("_w"), *lv)
    rw = right.select(key, w(right).alias("_w"), *rv)
    return (lw.join(rw, [key, "_w"], "inner")
            .select(key, from_micros(F.col("_w")).alias("window_start"),
                    from_micros(F.col("_w") + F.lit(step)).alias("window_end"), *lv, *rv))

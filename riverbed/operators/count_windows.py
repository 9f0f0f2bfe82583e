"""Count-based windows per key, in arrival order.

* ``count_window_tumbling``: every ``size`` rows of a key form a window;
  emit (key, window number, average). A key's unfinished last window
  emits nothing (the "average of each 3 values" processors).
* ``count_window_sliding``: every ``every`` rows of a key, evaluate the
  last ``size`` rows (count trigger that keeps its rows plus an evictor
  that trims to ``size``): at positions ``every, 2*every, ...`` emit the
  count and the sum of the rows ``rn-size+1 .. rn``.

A row without a value belongs to no window (batch and stream alike). Rows
are laid out in blocks as in ``prefix``: they move once, a hot key is cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .prefix import SPAN, in_blocks, key_values, running_totals


def _slim(df: DataFrame, keys: list[str], order: Sequence[str], value: str | Column | None
          ) -> DataFrame:
    v = F.lit(1).cast("long") if value is None else (
        F.col(value) if isinstance(value, str) else value)
    return df.select(*keys, *order, v.alias("_v")).where(F.col("_v").isNotNull())


def count_window_tumbling(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                          value: str | Column, size: int = 3, span: int = SPAN) -> DataFrame:
    """``keys, window_no, n, total, avg`` for each complete window of ``size`` rows."""
    keys = list(keys)
    numbered = running_totals(_slim(df, keys, order, value), keys, order, count_col="_rn",
                              span=span)
    win = (F.floor((F.col("_rn") - 1) / size) + 1).cast("long")
    return (numbered.groupBy(*keys, win.alias("window_no"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("_v").alias("total"))
            .where(F.col("n") == size)
            .select(*keys, "window_no", "n", "total",
                    (F.col("total").cast("double") / F.col("n")).alias("avg")))


def count_window_sliding(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                         every: int = 2, size: int = 3,
                         value: str | Column | None = None, span: int = SPAN) -> DataFrame:
    """``keys, rn, n, total`` at every ``every``-th row of a key.

    ``n`` = rows in the evaluated window (``min(rn, size)``); ``total`` =
    sum of ``value`` over them (the row count when ``value`` is None, i.e.
    the word-count case where every row carries 1). A window that reaches
    back over its block's start takes the rest from the last ``size - 1``
    values of the blocks before, which travel with the block's offset.
    """
    keys = list(keys)
    slim = _slim(df, keys, order, value)
    b = in_blocks(slim, keys, order, span, only=[*order, "_v"])
    inside = b.inside()
    rows = b.rows.withColumns({
        "_l": F.count(F.lit(1)).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_own": F.sum("_v").over(inside.rowsBetween(-(size - 1), Window.currentRow)),
        "_more": F.lead(F.lit(True), max(1, size - 1)).over(inside)})
    # the last size - 1 rows of a block: its count, and the values that later windows reach
    last = rows.where("_more IS NULL").groupBy(*b.by).agg(
        F.max("_l").alias("_c"), F.sort_array(F.collect_list(F.struct("_l", "_v"))).alias("_last"))
    # every block holds a row at least, so size - 1 blocks back are enough
    near = b.across().rowsBetween(-(size - 1), -1) if size > 1 else b.across().rowsBetween(0, 0)
    before = b.across().rowsBetween(Window.unboundedPreceding, -1)
    tail = F.flatten(F.collect_list(F.transform("_last", lambda x: x["_v"])).over(near))
    kind = rows.schema["_own"].dataType
    # per block, once: the sum of the k values before it (as many as there are), k = 0 .. size - 1
    reach = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda k: F.aggregate(
        F.slice("_tail", F.greatest(F.size("_tail") - k + 1, F.lit(1)), k),
        F.lit(0).cast(kind), lambda a, x: (a + x).cast(kind)))
    offsets = last.select(*b.by, F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_o"),
                          tail.alias("_tail")).select(*b.by, "_o", reach.alias("_reach"))
    short = F.greatest(F.lit(0), F.lit(size) - F.col("_l")).cast("int")
    rn = F.col("_l") + F.col("_o")
    return (b.join(rows, offsets)
            .select(*key_values(slim, keys), rn.alias("rn"),
                    F.least(rn, F.lit(size)).cast("long").alias("n"),
                    (F.col("_own") + F.get("_reach", short)).alias("total"))
            .where(F.col("rn") % every == 0))

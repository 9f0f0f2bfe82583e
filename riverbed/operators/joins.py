"""Joins: inner, outer with a fill value, lookup with a default.

Outer joins mark the missing *row*, not a missing field: a matched row
whose own value is NULL stays NULL; only columns of an absent side get
the fill (strings get ``fill``, other types stay NULL).

Each join is one Spark join of two scans, so Catalyst and AQE choose the
strategy from sizes in bytes known at run time (broadcast below the session's
threshold, else sort-merge with split of skewed partitions: both sides of an
inner join, the preserved side of a left or right join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

NULL_FILL = "null"  # fixed value: the text written for a missing side


def _filled(df: DataFrame, cols: list[str], present: str, fill: str | None):
    types = {f.name: f.dataType for f in df.schema.fields}
    return [F.when(F.col(present).isNull(), F.lit(fill)).otherwise(F.col(c)).alias(c)
            if fill is not None and isinstance(types[c], StringType) else F.col(c) for c in cols]


def equi_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner",
              fill: str | None = NULL_FILL) -> DataFrame:
    """Join on the column ``key`` present in both inputs.

    Output: ``key, <left columns>, <right columns>``. For ``right`` the key
    comes from the right row, for ``full`` from whichever side exists.
    """
    how = {"left_outer": "left", "right_outer": "right", "outer": "full",
           "full_outer": "full"}.get(how, how)
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(how)
    lcols = [c for c in left.columns if c != key]
    rcols = [c for c in right.columns if c != key]
    if set(lcols) & set(rcols):
        raise ValueError(f"column names clash: {set(lcols) & set(rcols)}")
    if how == "inner":
        return left.join(right, key, "inner").select(key, *lcols, *rcols)
    marked_left = left.withColumn("_l_on", F.lit(True))
    marked_right = right.withColumn("_r_on", F.lit(True))
    return marked_left.join(marked_right, key, how).select(
        key, *_filled(left, lcols, "_l_on", fill), *_filled(right, rcols, "_r_on", fill))


def lookup(probe: DataFrame, dim: DataFrame, probe_key: str, dim_key: str, value: str,
           out: str | None = None, default=0, order: str | None = None) -> DataFrame:
    """Add ``out`` = ``dim[value]`` looked up by key, ``default`` when the key is absent.

    A map built from the dimension keeps the *last* entry per key; with
    ``order`` that is the row with the largest ``order`` (``max_by``), so the
    result does not depend on partition order. The reduced dimension is sent to
    every task when its size in bytes, known once it is computed, is below the
    broadcast threshold; otherwise both sides are shuffled.
    """
    out = out or value
    agg = F.max_by(value, order) if order else F.any_value(value)
    table = (dim.groupBy(F.col(dim_key).alias("_lk_key"))
             .agg(agg.alias("_lk_val"))
             .withColumn("_lk_hit", F.lit(True)))
    j = probe.join(table, probe[probe_key] == table["_lk_key"], "left")
    filled = F.when(F.col("_lk_hit").isNull(), F.lit(default)).otherwise(F.col("_lk_val"))
    cols = [c for c in probe.columns if c != out]
    return j.select(*cols, filled.alias(out))

"""Per-key running totals in which rows move once and hot keys are cut.

``Window.partitionBy(key).orderBy(seq)`` sends every row of a key to one
task. Here a key's rows are cut into blocks by a pure function of the
leading order column (``floor(order / span)``): no sampling, no second pass
to find block edges, and a retried task cuts the same blocks.

1. One exchange of the rows on ``(key, block)``.
2. Running totals inside each block with an ordinary window.
3. One row per ``(key, block)`` with its count, sums and first order value,
   aggregated before any shuffle; a window over these rows gives each block
   the totals of the blocks before it.
4. The offsets are joined back on ``(key, block)``. Rows are already laid out
   that way, so only the offsets move.

Keys are compared through non-null stand-ins (text plus a null flag) made
once and used by exchange, window and join alike; a null-safe join condition
would hash on other expressions and shuffle the rows again.

A task holds at most ``span`` rows of a key when the leading order column is
a unique integer; choose ``span`` so that this fits an executor. The offset
table has one row per key and block. The order must be unique within a key,
or running values are undefined (as for a ``ROWS`` frame).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from ..functions.timefns import to_micros

#: order values per block: ids of about a million rows
SPAN = 1 << 20
_BLOCK = "_rb_block"


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


@dataclass
class Blocks:
    """Rows with their ``(key, block)``, before (``tagged``) and after (``rows``) the one
    exchange; the key stand-ins and windows."""

    tagged: DataFrame
    rows: DataFrame
    keys: list[str]
    order: list[str]

    @property
    def by(self) -> list[str]:
        return [*self.keys, _BLOCK]

    def inside(self):
        return Window.partitionBy(*self.by).orderBy(*self.order)

    def across(self):
        return Window.partitionBy(*self.keys).orderBy(_BLOCK)

    def join(self, rows: DataFrame, per_block: DataFrame) -> DataFrame:
        return rows.join(per_block, self.by)


def in_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str], span: int = SPAN,
              only: Sequence[str] | None = None) -> Blocks:
    """Exchange the rows once on (key, ``floor(order[0] / span)``); times count in microseconds.

    ``only``: the columns to carry (default: all). Branches that read the same
    columns share the exchange.
    """
    lead = F.col(order[0])
    if isinstance(df.schema[order[0]].dataType, (TimestampType, TimestampNTZType)):
        lead = to_micros(order[0])
    stand_ins = key_stand_ins(keys)
    block = F.floor(lead / F.lit(span)).cast("long")
    laid = df.withColumns({**stand_ins, _BLOCK: F.coalesce(block, F.lit(-(1 << 62)))})
    if only is not None:
        laid = laid.select(*stand_ins, _BLOCK, *only)
    return Blocks(laid, laid.repartition(*stand_ins, _BLOCK), list(stand_ins), list(order))


def key_stand_ins(keys: Sequence[str], mark: str = "_rb_") -> dict[str, Column]:
    """Non-null stand-ins of the key columns: text and a null flag each."""
    out = {}
    for i, k in enumerate(keys):
        out[f"{mark}k{i}"] = F.coalesce(F.col(k).cast("string"), F.lit(""))
        out[f"{mark}n{i}"] = F.col(k).isNull()
    return out


def key_values(df: DataFrame, keys: Sequence[str], mark: str = "_rb_") -> list[Column]:
    """The key columns of ``df`` read back from their stand-ins (text and null flag)."""
    return [F.when(~F.col(f"{mark}n{i}"), F.col(f"{mark}k{i}").cast(df.schema[k].dataType)).alias(k)
            for i, k in enumerate(keys)]


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   count_col: str | None = "rn",
                   sums: Mapping[str, str | Column] | None = None,
                   next_col: str | None = None, span: int = SPAN) -> DataFrame:
    """Add per-key running values in ``order`` (ascending, unique per key).

    ``count_col``: 1-based position of the row inside its key (row_number).
    ``sums``: ``{out_name: value}``; running sum up to and including the row.
    ``next_col``: value of the single order column on the next row of the
    same key (NULL on a key's last row), i.e. ``lead(order[0])``.
    ``span``: order values (microseconds for times) per block.
    """
    if next_col is not None and len(order) != 1:
        raise ValueError("next_col needs exactly one order column")
    sums = {f"_rb_v{i}": (name, _as_col(v)) for i, (name, v) in enumerate((sums or {}).items())}
    b = in_blocks(df.withColumns({c: v for c, (_, v) in sums.items()}) if sums else df,
                  keys, order, span)

    upto = b.inside().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = {f"{c}_l": F.sum(c).over(upto) for c in sums}
    if count_col:
        local["_rb_l"] = F.count(F.lit(1)).over(upto)
    if next_col:
        local["_rb_lead"] = F.lead(order[0]).over(b.inside())
    rows = b.rows.withColumns(local)

    totals = [F.count(F.lit(1)).alias("_rb_c"), *(F.sum(c).alias(f"{c}_t") for c in sums)]
    if next_col:
        totals.append(F.min(order[0]).alias("_rb_first"))
    per_block = b.tagged.groupBy(*b.by).agg(*totals)
    before = b.across().rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.select(
        *b.by, F.coalesce(F.sum("_rb_c").over(before), F.lit(0)).alias("_rb_o"),
        *(F.coalesce(F.sum(f"{c}_t").over(before), F.lit(0)).alias(f"{c}_o") for c in sums),
        *([F.lead("_rb_first").over(b.across()).alias("_rb_next")] if next_col else []))

    out = [F.col(c) for c in df.columns]
    if count_col:
        out.append((F.col("_rb_l") + F.col("_rb_o")).alias(count_col))
    out += [(F.coalesce(F.col(f"{c}_l"), F.lit(0)) + F.col(f"{c}_o")).alias(name)
            for c, (name, _) in sums.items()]
    if next_col:
        out.append(F.coalesce("_rb_lead", "_rb_next").alias(next_col))
    return b.join(rows, offsets).select(*out)

"""A function over all rows of a window, in order, without gathering the window.

``WindowFunction`` code that needs every row of a window at once (a median, anything
that depends on the order of the rows) is written as a fold: it sees the rows batch by
batch, in order, knows where in the window each batch begins and how many rows the
window has, and keeps a partial result. Partial results merge in order.

1. A window's rows are cut into blocks of the leading order column
   (``floor(order / span)``), one exchange deals them by (window, block), and each task
   sorts its blocks. A hot window is thus spread over many tasks.
2. Every block has one header row with the window's rows before it and in total. It
   comes from counts per (window, block), aggregated before any shuffle, and travels
   through the same exchange; sorted first, it also marks where a block begins.
3. ``mapInArrow`` carries the fold's state from batch to batch and gives one partial row
   per block; a second exchange brings a window's partial rows together, in order.

A task holds one Arrow batch and one state. Rows that share the leading order value
stay in one task, which reads them as a stream.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, TimestampNTZType, TimestampType

from ..functions.timefns import duration_micros, floor_to, from_micros, to_micros


class Fold:
    """What to compute; ``partial`` and ``result`` are DDL of the two kinds of rows."""

    partial: str
    result: str
    #: columns that ``add`` reads
    columns: Sequence[str]

    def start(self) -> Any:
        """State before the first row."""
        raise NotImplementedError

    def add(self, state: Any, rows: pa.RecordBatch, first: int, total: int) -> Any:
        """State after ``rows``, the window's rows from position ``first`` (0-based) on."""
        raise NotImplementedError

    def give(self, state: Any) -> tuple:
        """The state as a row of ``partial``."""
        raise NotImplementedError

    def merge(self, state: Any, row: dict) -> Any:
        """State after the block that gave ``row``; ``state`` covers the blocks before it."""
        raise NotImplementedError

    def finish(self, state: Any, total: int) -> tuple:
        """The window's row of ``result``."""
        raise NotImplementedError


class Median(Fold):
    """Median of an integer column, the mean of the two middle rows; order by that column."""

    partial, result = "lo long, hi long", "median double"

    def __init__(self, value: str):
        self.columns = [value]

    def start(self):
        return [None, None]

    def add(self, state, rows, first, total):
        for i, at in enumerate(((total - 1) // 2, total // 2)):
            if first <= at < first + len(rows):
                state[i] = rows.column(0)[at - first].as_py()
        return state

    def give(self, state):
        return tuple(state)

    def merge(self, state, row):
        return [row["lo"] if state[0] is None else state[0],
                row["hi"] if state[1] is None else state[1]]

    def finish(self, state, total):
        return (None if state[0] is None else (state[0] + state[1]) / 2,)


class OrderedDigest(Fold):
    """What only the rows' order tells, of an integer column: ``first`` and ``last`` value,
    ``checksum`` (sum of position times value, positions from 1), and ``longest_rise``, the
    most rows in a row of which none is below the one before it."""

    partial = ("n long, s long, checksum long, first_v long, last_v long, best long, head long, "
               "tail long")
    result = "first_v long, last_v long, checksum long, longest_rise long"

    def __init__(self, value: str):
        self.columns = [value]

    def start(self):
        return None

    def add(self, state, rows, first, total):
        v = rows.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        drops = np.flatnonzero(v[1:] < v[:-1]) + 1
        runs = np.diff(np.concatenate([[0], drops, [len(v)]]))
        return self.merge(state, {
            "n": len(v), "s": int(v.sum()), "checksum": int((np.arange(1, len(v) + 1) * v).sum()),
            "first_v": int(v[0]), "last_v": int(v[-1]), "best": int(runs.max()),
            "head": int(runs[0]), "tail": int(runs[-1])})

    def give(self, state):
        return tuple(state.values())

    def merge(self, state, row):
        if state is None:
            return {k: row[k] for k in ("n", "s", "checksum", "first_v", "last_v", "best", "head", "tail")}
        joined = state["last_v"] <= row["first_v"]
        across = state["tail"] + row["head"] if joined else 0
        return {
            "n": state["n"] + row["n"], "s": state["s"] + row["s"],
            "checksum": state["checksum"] + row["checksum"] + state["n"] * row["s"],
            "first_v": state["first_v"], "last_v": row["last_v"],
            "best": max(state["best"], row["best"], across),
            "head": across if joined and state["head"] == state["n"] else state["head"],
            "tail": across if joined and row["tail"] == row["n"] else row["tail"]}

    def finish(self, state, total):
        return state["first_v"], state["last_v"], state["checksum"], state["best"]


def _blocks(rows: DataFrame, keys: list[str], order: list[str], fold: Fold) -> DataFrame:
    """Rows and header rows, dealt by (keys, window, block) and sorted."""
    by = [*keys, "_w", "_b"]
    in_window = Window.partitionBy(*keys, "_w")
    before = in_window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    headers = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).select(
        *by, F.lit(0).alias("_h"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"),
        F.sum("_n").over(in_window).alias("_total"))
    both = rows.withColumn("_h", F.lit(1)).unionByName(headers, allowMissingColumns=True)
    return both.repartition(*by).sortWithinPartitions(*by, "_h", *order) \
        .select(*by, "_h", "_first", "_total", *dict.fromkeys(fold.columns))


def fold_windows(df: DataFrame, ts: str, size: str, order: Sequence[str], fold: Fold,
                 keys: Sequence[str] = (), span: int = 1 << 20) -> DataFrame:
    """``keys, window_start, window_end, n`` and the fold's result per tumbling window.

    ``order``: the rows' order inside a window; the first column is an integer or a time,
    and ``span`` of it (microseconds for times) make a block. A null there comes first. A
    row without a time belongs to no window.
    """
    keys, order, step = list(keys), list(order), duration_micros(size)
    lead = F.col(order[0])
    if isinstance(df.schema[order[0]].dataType, (TimestampType, TimestampNTZType)):
        lead = to_micros(order[0])
    needed = dict.fromkeys([*keys, *order, *fold.columns])
    rows = df.where(F.col(ts).isNotNull()).select(
        floor_to(to_micros(ts), step).alias("_w"),
        F.coalesce(F.floor(lead / F.lit(span)).cast("long"), F.lit(-(1 << 62))).alias("_b"), *needed)
    laid = _blocks(rows, keys, order, fold)

    head = StructType([laid.schema[c] for c in keys])
    partial = StructType(head.fields + StructType.fromDDL(
        f"_w long, _b long, _first long, _total long, {fold.partial}").fields)
    result = StructType(head.fields + StructType.fromDDL(f"_w long, n long, {fold.result}").fields)
    partial_arrow, result_arrow = to_arrow_schema(partial), to_arrow_schema(result)
    n_by = len(keys) + 2

    def fold_blocks(batches):
        block, state, at, total = None, None, 0, 0

        def closed():
            return dict(zip(partial_arrow.names, (*block, first, total, *fold.give(state))))

        first = 0
        for batch in batches:
            out = []
            headers = np.flatnonzero(batch.column(n_by).to_numpy() == 0).tolist()
            edges = sorted({0, *headers, len(batch)})
            values = batch.select(range(n_by + 3, batch.num_columns))
            for lo, hi in zip(edges, edges[1:]):
                if lo in headers:
                    if block is not None:
                        out.append(closed())
                    block = [batch.column(i)[lo].as_py() for i in range(n_by)]
                    at = first = batch.column(n_by + 1)[lo].as_py()
                    total, state, lo = batch.column(n_by + 2)[lo].as_py(), fold.start(), lo + 1
                if hi > lo:
                    state = fold.add(state, values.slice(lo, hi - lo), at, total)
                    at += hi - lo
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=partial_arrow)
        if block is not None:
            yield pa.RecordBatch.from_pylist([closed()], schema=partial_arrow)

    def merge_blocks(batches):
        window, state, total = None, None, 0

        def closed():
            return dict(zip(result_arrow.names, (*window, total, *fold.finish(state, total))))

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["_first"] == 0:          # a window's first block
                    if window is not None:
                        out.append(closed())
                    window, total = [row[c] for c in (*keys, "_w")], row["_total"]
                    state = fold.start()
                state = fold.merge(state, row)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=result_arrow)
        if window is not None:
            yield pa.RecordBatch.from_pylist([closed()], schema=result_arrow)

    parts = laid.mapInArrow(fold_blocks, partial)
    whole = parts.repartition(*keys, "_w").sortWithinPartitions(*keys, "_w", "_b") \
        .mapInArrow(merge_blocks, result)
    names = [f.name for f in StructType.fromDDL(fold.result)]
    return whole.select(*keys, from_micros(F.col("_w")).alias("window_start"),
                        from_micros(F.col("_w") + F.lit(step)).alias("window_end"), "n", *names)


def window_median(df: DataFrame, ts: str, size: str, value: str, keys: Sequence[str] = (),
                  span: int = 1 << 20) -> DataFrame:
    """``n, median`` of the non-null values of every window that has any."""
    some = df.where(F.col(value).isNotNull())
    return fold_windows(some, ts, size, [value], Median(value), keys, span)


def window_digest(df: DataFrame, ts: str, size: str, order: Sequence[str], value: str,
                  keys: Sequence[str] = (), span: int = 1 << 20) -> DataFrame:
    """``n, first_v, last_v, checksum, longest_rise`` of every window's non-null values in ``order``."""
    some = df.where(F.col(value).isNotNull())
    return fold_windows(some, ts, size, order, OrderedDigest(value), keys, span)

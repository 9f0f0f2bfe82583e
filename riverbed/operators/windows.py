"""Time windows: tumbling and sliding, batch and stream.

Window semantics (same as the original engine and as ``F.window``):
windows are ``[start, start + size)``, starts are multiples of ``slide``
from the epoch, and a window with no rows produces no row.

Two physical forms for sliding windows:

* ``expand``: ``F.window(ts, size, slide)`` copies every row into each of
  its ``size / slide`` windows, then aggregates. Works on streams.
* ``sweep`` (batch): a row adds +1 at the start of its first window and
  -1 just after its last. Change points are summed, a running sum per key
  gives the value at every change point, and each constant run is expanded
  into window rows. Work is linear in input rows plus output windows rather
  than ``rows * size / slide``; a 1 h / 5 s window would otherwise copy
  each row 720 times. Only subtractive aggregates (count, sum) qualify.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.timefns import duration_micros, floor_to, from_micros, to_micros
from .prefix import running_totals


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _interval(d: str | int) -> str:
    return f"{duration_micros(d)} microseconds"


def window_agg(df: DataFrame, ts: str, size: str, aggs: Sequence[Column],
               keys: Sequence[str] = (), slide: str | None = None) -> DataFrame:
    """Aggregate per (keys, window). Tumbling when ``slide`` is None.

    Returns ``window_start, window_end, *keys, *aggs``. Works on batch and
    streaming frames (add ``withWatermark`` upstream for append mode).
    Spark's partial aggregation combines map-side, so a window holding a
    large share of the rows still costs one row per task before the shuffle.
    """
    w = (F.window(ts, _interval(size)) if slide is None
         else F.window(ts, _interval(size), _interval(slide)))
    # a row without a time belongs to no window
    out = df.where(F.col(ts).isNotNull()).groupBy(w.alias("_w"), *keys).agg(*aggs)
    names = [c for c in out.columns if c != "_w"]
    return out.select(F.col("_w.start").alias("window_start"),
                      F.col("_w.end").alias("window_end"), *names)


def tumbling_sum(df: DataFrame, ts: str, size: str, value: str | Column,
                 keys: Sequence[str] = ()) -> DataFrame:
    """Incremental reduce (sum) per tumbling window, plus the row count."""
    return window_agg(df, ts, size, [F.count(F.lit(1)).alias("n"),
                                     F.sum(_c(value)).alias("total")], keys)


def tumbling_avg(df: DataFrame, ts: str, size: str, value: str | Column,
                 keys: Sequence[str] = ()) -> DataFrame:
    """Mergeable (count, sum) average per tumbling window, as a double."""
    return window_agg(df, ts, size, [
        F.count(F.lit(1)).alias("n"),
        (F.sum(_c(value)).cast("double") / F.count(F.lit(1))).alias("avg")], keys)


def sliding_count_expand(df: DataFrame, ts: str, size: str, slide: str,
                         keys: Sequence[str], sums: Mapping[str, str | Column] | None = None
                         ) -> DataFrame:
    """Built-in sliding window count (and sums); the streaming form."""
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.sum(_c(v)).alias(name) for name, v in (sums or {}).items()]
    return window_agg(df, ts, size, aggs, keys, slide=slide)


# Change points are multiples of the slide; a block of the running sum spans this many
# slides, so a task holds at most that many points of a key whatever the data volume.
SLIDES_PER_BLOCK = 1 << 16


def change_runs(df: DataFrame, ts: str, size_us: int, slide_us: int, keys: list[str],
                sums: Mapping[str, str | Column]) -> DataFrame:
    """``keys, p, p_next, n, *sums``: per key the runs of window starts with equal counts.

    Every row gives two change points, +1 at its first window start and -1 after
    its last; they are summed per point (map-side first), and a running sum over
    the points, cut into blocks of time, gives each run's value.
    """
    t = to_micros(ts)
    # windows [s, s+size) with s a multiple of slide and t - size < s <= t
    first = floor_to(t - F.lit(size_us), slide_us) + F.lit(slide_us)
    stop = floor_to(t, slide_us) + F.lit(slide_us)
    vals = {f"_s{i}": _c(v) for i, v in enumerate(sums.values())}
    plus = F.struct(first.alias("p"), F.lit(1).cast("long").alias("d"),
                    *[v.alias(k) for k, v in vals.items()])
    minus = F.struct(stop.alias("p"), F.lit(-1).cast("long").alias("d"),
                     *[(-v).alias(k) for k, v in vals.items()])
    points = (df.where(F.col(ts).isNotNull())
              .select(*keys, F.explode(F.array(plus, minus)).alias("_e"))
              .select(*keys, "_e.*")
              .groupBy(*keys, "p")
              .agg(F.sum("d").alias("d"), *[F.sum(k).alias(k) for k in vals]))
    running = {"n": F.col("d"), **dict(zip(sums, (F.col(k) for k in vals)))}
    run = running_totals(points, keys, ["p"], count_col=None, sums=running, next_col="p_next",
                         span=SLIDES_PER_BLOCK * slide_us)
    return run.where(F.col("n") > 0).select(*keys, "p", "p_next", "n", *sums)


def cut_runs(runs: DataFrame, slide_us: int, slides: int) -> DataFrame:
    """Cut every run at the edges of time buckets of ``slides`` slides; adds ``bucket``."""
    width = F.lit(slides * slide_us)
    first, last = F.floor(F.col("p") / width), F.floor((F.col("p_next") - 1) / width)
    cut = runs.withColumn("bucket", F.explode(F.sequence(first, last)))
    return cut.withColumns({"p": F.greatest(F.col("p"), F.col("bucket") * width),
                            "p_next": F.least(F.col("p_next"), (F.col("bucket") + 1) * width)})


def window_starts(slide_us: int) -> Column:
    """The window starts of a run, one row each."""
    return F.explode(F.sequence(F.col("p"), F.col("p_next") - F.lit(slide_us), F.lit(slide_us)))


#: window starts that one piece of a run expands to at most
SLIDES_PER_PIECE = 720


def sliding_count_sweep(df: DataFrame, ts: str, size: str, slide: str,
                        keys: Sequence[str], sums: Mapping[str, str | Column] | None = None
                        ) -> DataFrame:
    """Sliding window count (and sums) by change-point sweep; batch only.

    Output equals ``sliding_count_expand`` row for row:
    ``window_start, window_end, *keys, n, *sums`` (times in the input's
    NTZ wall clock). Runs are few next to the windows they expand to, so they
    are cut into pieces of bounded length and spread before they expand.
    """
    size_us, slide_us = duration_micros(size), duration_micros(slide)
    keys, sums = list(keys), dict(sums or {})
    runs = change_runs(df, ts, size_us, slide_us, keys, sums)
    pieces = cut_runs(runs, slide_us, SLIDES_PER_PIECE)
    out = (spread(pieces, "bucket", *keys)
           .select(*keys, window_starts(slide_us).alias("_s"), "n", *sums))
    return out.select(from_micros(F.col("_s")).alias("window_start"),
                      from_micros(F.col("_s") + F.lit(size_us)).alias("window_end"),
                      *keys, "n", *sums.keys())


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Hash the rows over all shuffle partitions. The explicit count keeps AQE from
    merging partitions by their small input when each row expands to many."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *by)


def sliding_count(df: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str],
                  sums: Mapping[str, str | Column] | None = None,
                  method: str = "auto") -> DataFrame:
    """Per-key sliding window count; ``method`` = ``auto`` | ``sweep`` | ``expand``.

    ``auto`` depends on the parameters only, never on the data: the sweep costs
    two change points per row, the built-in form ``size / slide`` copies, so the
    sweep is taken for batch frames from 4-fold overlap on (streams cannot sweep).
    Both give the same rows.
    """
    if method == "auto":
        dense = duration_micros(size) >= 4 * duration_micros(slide)
        method = "sweep" if dense and not df.isStreaming else "expand"
    if method == "sweep":
        return sliding_count_sweep(df, ts, size, slide, keys, sums)
    if method == "expand":
        return sliding_count_expand(df, ts, size, slide, keys, sums)
    raise ValueError(method)

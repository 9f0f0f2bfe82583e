"""Stream forms of the operators.

Stateless and window operators reuse the batch functions (they are plain
DataFrame code; a watermark upstream makes windows final). Where Spark
has no built-in (count windows, the click cap) a keyed stateful
processor runs per bucket of keys.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.timefns import duration_micros, floor_to, from_micros, to_micros
from ..operators.prefix import key_stand_ins, key_values
from ..operators.windows import sliding_count_expand
from .stateful import ClickCap, CountTriggerEvictor, CountWindowAverage, TopNPerWindow


#: key stand-ins as pandas columns: rows reach a processor as named tuples, whose fields
#: cannot begin with an underscore
MARK = "rb_"


def _ddl(df: DataFrame, cols: Sequence[str]) -> str:
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return ", ".join(f"{c} {types[c]}" for c in cols)


def event_time(df: DataFrame, ts: str, delay: str = "10 seconds") -> DataFrame:
    """Cast ``ts`` to an instant (``withWatermark`` rejects NTZ) and set the watermark
    to max event time minus ``delay``."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def open_rows(df: DataFrame, ts: str) -> DataFrame:
    """``df`` without the closing row of ``sources.tables.replay``; apply after ``event_time``.

    The closing row has to move the watermark before it goes, but Catalyst pushes a filter
    through a watermark and down to the scan unless it names the time column; so this one
    compares the time with a date before all others."""
    return df.where(~F.col("_closing") | (F.col(ts) < F.expr("timestamp'0001-01-02'"))).drop("_closing")


def value_blocks(df: DataFrame, keys: Sequence[str], seq: str, value: str | None, span: int,
                 tasks: int) -> DataFrame:
    """A micro-batch's values per key (as its stand-ins) and ``block`` of ``span`` sequence
    numbers, in order: ``vals``.

    Blocks, not keys, are dealt over ``tasks`` groups, so the rows of a hot key are sorted
    in many tasks, and what moves on per key is one array per block. A row without a value
    belongs to no window."""
    stand_ins = key_stand_ins(keys, MARK)
    v = F.lit(1).cast("long") if value is None else F.col(value).cast("long")
    block = F.floor(F.col(seq) / F.lit(span)).cast("long")
    by = [*stand_ins, "block"]
    rows = df.select(*(c.alias(k) for k, c in stand_ins.items()), F.col(seq).alias("_seq"), v.alias("_v"),
                     block.alias("block")).where(F.col("_v").isNotNull()) \
        .withColumn("_task", F.pmod(F.xxhash64(*by), F.lit(tasks)))

    def sort(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in (*by, "_seq")])
        return table.group_by(by, use_threads=False).aggregate([("_v", "list")]) \
            .rename_columns([*by, "vals"]).select([*by, "vals"])

    return rows.groupBy("_task").applyInArrow(sort, f"{_ddl(rows, by)}, vals array<long>")


def _by_key(df: DataFrame, keys: list[str], blocks: DataFrame, proc, buckets: int) -> DataFrame:
    """Run a count-window processor per bucket of keys. Keys are the stand-ins: integer keys
    with a null among them would reach Python as floats, and NaN equals no key."""
    bucket = F.pmod(F.xxhash64(*proc.key_names), F.lit(buckets)).cast("int").alias("_bucket")
    out = blocks.select(*blocks.columns, bucket).groupBy("_bucket").transformWithStateInPandas(
        proc, proc.output_schema(_ddl(blocks, proc.key_names)), "append", "None")
    return out.select(*key_values(df, keys, MARK), *[c for c in out.columns if c not in proc.key_names])


def count_window_avg_stream(df: DataFrame, keys: Sequence[str], seq: str, value: str,
                            size: int = 3, state: str = "list", span: int = 1 << 16,
                            tasks: int = 64, buckets: int = 128) -> DataFrame:
    """Average of every ``size`` rows per key; ``state`` = list | value | map.

    Keys are dealt into ``buckets``; choose as many as make a bucket's keys and its values of
    one micro-batch fit a task (a run keeps its number of buckets).
    """
    proc = CountWindowAverage(list(key_stand_ins(keys, MARK)), size=size, state=state)
    return _by_key(df, list(keys), value_blocks(df, keys, seq, value, span, tasks), proc, buckets)


def count_window_sliding_stream(df: DataFrame, keys: Sequence[str], seq: str,
                                value: str | None = None, every: int = 2, size: int = 3,
                                span: int = 1 << 16, tasks: int = 64,
                                buckets: int = 128) -> DataFrame:
    """Every ``every`` rows per key, the last ``size`` of them. ``buckets``: as for
    :func:`count_window_avg_stream`."""
    proc = CountTriggerEvictor(list(key_stand_ins(keys, MARK)), every=every, size=size)
    return _by_key(df, list(keys), value_blocks(df, keys, seq, value, span, tasks), proc, buckets)


def click_cap_stream(df: DataFrame, keys: Sequence[str], ts: str, seq: str,
                     carry: Sequence[str] = (), cap: int = 100, period: str = "1 day",
                     processing_time: bool = False, clock_ms: int = 0, buckets: int = 128
                     ) -> DataFrame:
    """Tagged rows (``pass`` / ``alert``) with ``ts`` and ``period_start``.

    By default the period comes from event time (replayable) and the stored
    state is cleared by an event-time timer at the period's end; this needs
    a watermark on ``ts`` upstream. With ``processing_time=True`` the period
    is the wall-clock period of the micro-batch and a processing-time timer
    resets it, as in the original program (not replayable); ``clock_ms`` sets its clock
    that much ahead of the engine's.

    Keys are dealt into ``buckets``; choose as many as make a bucket's open keys and its
    rows of one micro-batch fit a task (a run keeps its number of buckets).
    """
    keys = list(keys)
    step = duration_micros(period)
    carry = [c for c in [seq, *carry] if c not in keys]
    stand_ins = key_stand_ins(keys, MARK)             # exact in pandas, nulls included
    prepared = df.select(*(c.alias(k) for k, c in stand_ins.items()), *carry, ts,
                         to_micros(ts).alias("ts_us"),
                         floor_to(to_micros(ts), step).alias("period_us"),
                         F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("_bucket"))
    # the event-time column must be an output column: ts is passed through
    schema = (f"{_ddl(prepared, list(stand_ins))}, {_ddl(df, carry)}, {ts} timestamp, ts_us long, "
              "period_us long, tag string")
    if not df.isStreaming:
        raise ValueError("click_cap_stream expects a streaming frame; use operators.clicks")
    proc = ClickCap(list(stand_ins), [*carry, ts], cap=cap, period_us=step, seq=seq,
                    processing_time=processing_time, clock_ms=clock_ms)
    grouped = prepared.groupBy("_bucket")
    if processing_time:
        out = grouped.transformWithStateInPandas(proc, schema, "append", "ProcessingTime")
    else:
        out = grouped.transformWithStateInPandas(proc, schema, "append", "EventTime",
                                                 eventTimeColumnName=ts)
    return out.select(*key_values(df, keys, MARK), *carry, ts,
                      from_micros(F.col("period_us"), ntz=False).alias("period_start"), "tag")


def window_join_stream(left: DataFrame, right: DataFrame, key: str, ts: str, size: str
                       ) -> DataFrame:
    """Stream-stream inner join on key inside the same tumbling window.

    Each side keeps only ``window`` as its event-time column (two event-time
    columns on one side are rejected); watermarks on both inputs let Spark
    drop join state once a window can no longer match.
    """
    step = f"{duration_micros(size)} microseconds"
    lv = [c for c in left.columns if c not in (key, ts)]
    rv = [c for c in right.columns if c not in (key, ts)]
    lw = left.select(F.col(key).alias("_lk"), F.window(ts, step).alias("_w"), *lv)
    rw = right.select(F.col(key).alias("_rk"), F.window(ts, step).alias("_rw"), *rv)
    j = lw.join(rw, (F.col("_lk") == F.col("_rk")) & (F.col("_w") == F.col("_rw")), "inner")
    return j.select(F.col("_lk").alias(key), F.col("_w.start").alias("window_start"),
                    F.col("_w.end").alias("window_end"), *lv, *rv)


def window_counts(df: DataFrame, ts: str, url: str, size: str, slide: str) -> DataFrame:
    """``url, window_end, n``: views per url and sliding window, updated as rows come."""
    return sliding_count_expand(df.select(ts, F.col(url).alias("url")), ts, size, slide, ["url"]) \
        .select("url", "window_end", "n")


def hot_pages_stream(df: DataFrame, ts: str, url: str, size: str = "10 minutes",
                     slide: str = "5 seconds", n: int = 3, salts: int = 16,
                     windows: int = 720) -> DataFrame:
    """Candidates for the top-n urls per sliding window, the keyed-process form.

    Window counts go to a processor keyed by (``windows`` neighbouring window ends, salt of
    the url) with an event-time timer at window end + 1 ms; each window keeps at
    most n entries per salt whatever the url count. All salts of a window are released
    by the same watermark: ``top_n_per_group`` over the (at most) ``n * salts``
    rows of a window gives its top n. Needs a watermark on ``ts`` upstream.
    """
    sz = f"{duration_micros(size)} microseconds"
    sl = f"{duration_micros(slide)} microseconds"
    counts = (df.groupBy(F.window(ts, sz, sl).alias("window"), F.col(url).alias("url"))
              .agg(F.count(F.lit(1)).alias("n")))
    end = F.unix_millis(F.col("window.end"))
    keyed = counts.select(F.floor(end / F.lit(duration_micros(slide) * windows // 1000)).alias("run"),
                          F.pmod(F.xxhash64("url"), F.lit(salts)).cast("int").alias("salt"),
                          end.alias("window_end_ms"), "url", "n")
    out = (keyed.groupBy("run", "salt")
           .transformWithStateInPandas(TopNPerWindow(n), TopNPerWindow.output_schema(),
                                       "append", "EventTime"))
    return out.select("url", F.timestamp_millis("window_end_ms").alias("window_end"), "n")


def with_processing_time(df: DataFrame, col: str = "proc_ts") -> DataFrame:
    """Stamp rows with processing time for processing-time windows.

    Spark evaluates ``current_timestamp()`` once per micro-batch, so every
    row of a batch gets the same stamp (the original stamps per row). Use
    with ``window_agg`` in update or complete mode; results are not
    replayable, which is why the registered queries use event time.
    """
    return df.withColumn(col, F.current_timestamp())

"""Registered *streaming* queries: a driver table replayed as a file stream,
processed by Structured Streaming to the end of the available input, and
read back from the sink. Results equal the batch twin, so each one is
checked against the same SQL.

Tables of events are replayed in event order, whatever the order of their files,
so no row falls behind the watermark and the processors see the rows in the
order of the batch twin. A micro-batch holds a bounded number of bytes; state lives in RocksDB under
the shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.parsing import parse_ad_click
from ..operators import aggregates, topn, windows
from ..operators.clicks import alert_message
from ..functions.text import text_lines
from ..session import shared_path
from ..sources.line_log import append_lines, stream_line_log
from ..sources.text import stream_text
from ..sources.tables import bytes_of, replay, stream_table as _stream, table
from ..streaming import operators as so
from ..streaming.runner import run_available, run_counting, run_outputs
from .catalog import BLACKLIST_CAP, ad_click_lines, cents


#: lines of a text file, and bytes of files in a micro-batch
TEXT_LINES, TEXT_BYTES = 1_000_000, 1 << 28
#: micro-batches, about, of a small table that must come in several; a large one has more, by its bytes
BATCHES = 4
#: state stores of such a run at least: shares of a micro-batch, which holds 128 MB at most
STORES = 8


def _ntz(c: str) -> F.Column:
    return F.col(c).cast("timestamp_ntz").alias(c)


def stream_word_count(spark: SparkSession, d: str) -> DataFrame:
    """Running word count over the documents stream (update mode: changed words only)."""
    docs = _stream(spark, d, "documents").select("text")
    return run_available(aggregates.word_count(docs, "text", ","), "word-count", "update",
                         keys=["word"])


def _events_et(spark, d):
    return so.event_time(_stream(spark, d, "events", order=["ts", "event_id"]), "ts", "10 seconds")


def stream_tumbling_sum(spark: SparkSession, d: str) -> DataFrame:
    """Per 1 h tumbling window: count and cents, updated as events arrive."""
    ev = _events_et(spark, d).select("ts", cents("value").alias("c"))
    agg = windows.tumbling_sum(ev, "ts", "1 hour", "c")
    out = run_available(agg, "tumbling-sum", "update", keys=["window_start", "window_end"])
    return out.select(_ntz("window_start"), _ntz("window_end"), "n", "total")


def stream_tumbling_full(spark: SparkSession, d: str) -> DataFrame:
    """Whole-window statistics per 1 h tumbling window, updated as events arrive."""
    ev = _events_et(spark, d).select("ts", cents("value").alias("c"))
    agg = windows.window_agg(ev, "ts", "1 hour", [
        F.count(F.lit(1)).alias("n"), F.sum("c").alias("total"),
        F.min("c").alias("min_c"), F.max("c").alias("max_c")])
    out = run_available(agg, "tumbling-full", "update", keys=["window_start", "window_end"])
    return out.select(_ntz("window_start"), _ntz("window_end"), "n", "total", "min_c", "max_c")


def stream_tumbling_avg(spark: SparkSession, d: str) -> DataFrame:
    """Average value cents per 1 h tumbling window, updated as events arrive."""
    ev = _events_et(spark, d).select("ts", cents("value").alias("c"))
    out = run_available(windows.tumbling_avg(ev, "ts", "1 hour", "c"), "tumbling-avg", "update",
                        keys=["window_start", "window_end"])
    return out.select(_ntz("window_start"), _ntz("window_end"), "n", "avg")


def stream_hot_pages(spark: SparkSession, d: str) -> DataFrame:
    """Top 3 urls (url = event_type) per 10 min window sliding by 1 min: view counts
    updated by the stream, ranked when read, so open windows are in the result."""
    counts = so.window_counts(_events_et(spark, d), "ts", "event_type", "10 minutes", "1 minute")
    counts = run_available(counts, "hot-pages", "update", keys=["url", "window_end"])
    best = topn.top_n_per_group(counts, ["window_end"], [F.col("n").desc(), F.col("url").asc()], 3)
    return best.select("url", _ntz("window_end"), "n")


def stream_hot_pages_timer(spark: SparkSession, d: str) -> DataFrame:
    """Top 3 urls per 10 min window sliding by 1 min, as a keyed process: every finished
    window's counts are ranked in map state and given out by a timer at its end. A closing
    row lets the last windows end too."""
    ev = _stream(spark, d, "events", order=["ts", "event_id"], close=("ts", "1 DAY"))
    ev = so.open_rows(so.event_time(ev, "ts", "10 seconds"), "ts")
    best = run_available(so.hot_pages_stream(ev, "ts", "event_type", "10 minutes", "1 minute", 3, salts=1),
                         "hot-pages-timer")
    best = topn.top_n_per_group(best, ["window_end"], [F.col("n").desc(), F.col("url").asc()], 3)
    return best.select("url", _ntz("window_end"), "n")


def stream_sliding_count(spark: SparkSession, d: str) -> DataFrame:
    """Clicks per province per 1 h window sliding by 5 min (built-in windows, update mode)."""
    ev = _events_et(spark, d).select("ts", F.col("event_type").alias("province"))
    agg = windows.sliding_count_expand(ev, "ts", "1 hour", "5 minutes", ["province"])
    out = run_available(agg, "sliding-count", "update",
                        keys=["window_start", "window_end", "province"])
    return out.select(_ntz("window_end"), "province", "n")


def stream_count_window_avg(spark: SparkSession, d: str) -> DataFrame:
    """Average of every 3 events per user, by a keyed stateful processor."""
    ev = _stream(spark, d, "events", order=["event_id"]).select("user_id", "event_id", cents("value").alias("c"))
    return run_available(so.count_window_avg_stream(ev, ["user_id"], "event_id", "c", 3),
                         "count-window-avg")


def stream_count_window_sliding(spark: SparkSession, d: str) -> DataFrame:
    """Every 2 events per user, the last 3 events' count and cents (count trigger + evictor)."""
    ev = _stream(spark, d, "events", order=["event_id"]).select("user_id", "event_id", cents("value").alias("c"))
    return run_available(
        so.count_window_sliding_stream(ev, ["user_id"], "event_id", "c", every=2, size=3),
        "count-window-sliding")


def _capped(spark, d):
    ev = _events_et(spark, d).select("event_id", "user_id",
                                     F.col("event_type").alias("ad_id"), "ts")
    return run_available(
        so.click_cap_stream(ev, ["user_id", "ad_id"], "ts", "event_id", cap=BLACKLIST_CAP,
                            period="1 day"), "click-cap")


def stream_blacklist_pass(spark: SparkSession, d: str) -> DataFrame:
    """Events passing the per-day cap, by the stateful click-cap processor."""
    return (_capped(spark, d).where(F.col("tag") == "pass")
            .select("event_id", "user_id", "ad_id", _ntz("ts")))


def stream_blacklist_alerts(spark: SparkSession, d: str) -> DataFrame:
    """One alert per (user, event_type, day) over the cap, from the same processor."""
    return (_capped(spark, d).where(F.col("tag") == "alert")
            .select("user_id", "ad_id", _ntz("period_start"),
                    F.lit(alert_message(BLACKLIST_CAP)).alias("message")))


def stream_window_join(spark: SparkSession, d: str) -> DataFrame:
    """Stream-stream join of two sources, each replayed with a watermark of its own: clicks
    and purchases (of ``events``) per user in 1 h tumbling windows."""
    ev = table(spark, d, "events")

    def side(kind: str, value: str) -> DataFrame:
        rows = ev.where(F.col("event_type") == kind).select("user_id", "ts", "event_id")
        rows = replay(rows, ["ts", "event_id"], bytes_of(spark, d, "events") // 2)
        rows = so.event_time(rows, "ts", "10 seconds")
        return rows.select(F.col("user_id").alias("k"), "ts", F.col("event_id").alias(value))

    out = run_available(so.window_join_stream(side("click", "v1"), side("purchase", "v2"), "k", "ts",
                                              "1 hour"), "window-join")
    return out.select("k", _ntz("window_start"), _ntz("window_end"), "v1", "v2")


def stream_log_word_count(spark: SparkSession, d: str) -> DataFrame:
    """Word count over a replayable log of lines: the documents' lines are appended to a log
    in partitions, which a Python data source reads by offsets."""
    lines = table(spark, d, "documents").select(F.explode(text_lines("text")).alias("value"))
    log = shared_path(spark, "line-log")
    append_lines(lines, log)
    words = aggregates.word_count(stream_line_log(spark, log), "value", ",", by_lines=False)
    return run_available(words, "log-word-count", "update", keys=["word"])


def stream_text_word_count(spark: SparkSession, d: str) -> DataFrame:
    """Word count over a folder of text files: the documents' lines are written as text and
    streamed file by file, by a run that is stopped after its first micro-batch and resumed."""
    lines = table(spark, d, "documents").select(F.explode(text_lines("text")).alias("value"))
    folder = shared_path(spark, "text-lines")
    lines.write.option("maxRecordsPerFile", TEXT_LINES).text(folder)
    words = aggregates.word_count(
        stream_text(spark, folder, bytes_per_trigger=TEXT_BYTES, line_sep="\n"),
        "value", ",", by_lines=False)
    run = f"text-{uuid.uuid4().hex}"
    run_available(words, "text-word-count", "update", keys=["word"], run=run, batches=1)
    return run_available(words, "text-word-count", "update", keys=["word"], run=run)


def _in_files(spark: SparkSession, d: str) -> DataFrame:
    """``events`` in event order, several micro-batches at every size."""
    return replay(table(spark, d, "events"), ["ts", "event_id"], bytes_of(spark, d, "events"), batches=BATCHES)


def _stores(spark: SparkSession) -> int:
    """State stores of a run in several micro-batches: they follow the cores and the bytes of a
    micro-batch, which are bounded, not the shuffle partitions meant for the whole table."""
    return max(STORES, spark.sparkContext.defaultParallelism)


def stream_resumed_sum(spark: SparkSession, d: str) -> DataFrame:
    """Count and cents per 1 h window by a run that is stopped after two micro-batches and
    resumed under its name: every event counts once."""
    ev = so.event_time(_in_files(spark, d), "ts", "10 seconds").select("ts", cents("value").alias("c"))
    agg, run = windows.tumbling_sum(ev, "ts", "1 hour", "c"), f"resumed-{uuid.uuid4().hex}"
    keys, stores = ["window_start", "window_end"], _stores(spark)
    run_available(agg, "resumed-sum", "update", keys=keys, run=run, batches=2, stores=stores)
    out = run_available(agg, "resumed-sum", "update", keys=keys, run=run, stores=stores)
    return out.select(_ntz("window_start"), _ntz("window_end"), "n", "total")


def stream_observed_count(spark: SparkSession, d: str) -> DataFrame:
    """Events and cents observed while they stream into a sink: metrics of every
    micro-batch, summed over a run that is stopped and resumed."""
    seen = _in_files(spark, d).observe("seen", F.count(F.lit(1)).alias("n"), F.sum(cents("value")).alias("total"))
    run = f"observed-{uuid.uuid4().hex}"
    run_counting(seen.select("event_id"), "observed", run=run, batches=2)
    _, totals = run_counting(seen.select("event_id"), "observed", run=run)
    got = totals["observed"]
    return spark.createDataFrame([(got.get("seen.n", 0), got.get("seen.total", 0))], "n long, total long")


def stream_late_rows(spark: SparkSession, d: str) -> DataFrame:
    """What an event-time operator drops: every 50th event arrives after all others, and
    those of them that are behind the watermark (the last time but 10 s) are dropped.

    ``n_in`` and ``n_late`` are the engine's own counts, ``n_kept`` the rows that came out."""
    ev = table(spark, d, "events").select("event_id", "ts")
    late = F.col("event_id") % 50 == 0
    rows = replay(ev.where(~late), ["ts", "event_id"], bytes_of(spark, d, "events"), then=ev.where(late),
                  batches=BATCHES)
    rows = so.event_time(rows, "ts", "10 seconds").dropDuplicates(["event_id", "ts"])
    kept, totals = run_counting(rows, "late-rows", stores=_stores(spark))
    return kept.agg(F.count(F.lit(1)).alias("n_kept")).select(
        F.lit(totals["rows"]).cast("long").alias("n_in"), "n_kept",
        F.lit(totals["late"]).cast("long").alias("n_late"))


def _ad_clicks(spark, d):
    """One run of the ad-click program with both outputs: parse click lines, cap them,
    alerts beside the passing clicks counted per province and sliding window."""
    # the lines hold whole seconds, so that is the order in which the cap takes them
    in_order = [F.date_trunc("second", "ts"), "event_id"]
    lines = ad_click_lines(_stream(spark, d, "events", order=in_order))
    rows = parse_ad_click(lines, extra=["event_id"]).withWatermark("ts", "10 seconds")
    tagged = so.click_cap_stream(rows, ["user_id", "ad_id"], "ts", "event_id",
                                 carry=["province"], cap=BLACKLIST_CAP, period="1 day")

    def counts(batch: DataFrame) -> DataFrame:
        # a micro-batch's share of each window; shares are summed when read
        passed = batch.where(F.col("tag") == "pass").select("ts", "province")
        return windows.sliding_count(passed, "ts", "1 hour", "5 seconds", ["province"],
                                     method="sweep").select("window_end", "province", "n")

    def alerts(batch: DataFrame) -> DataFrame:
        return batch.where(F.col("tag") == "alert").select(
            "user_id", "ad_id", _ntz("period_start"),
            F.lit(alert_message(BLACKLIST_CAP)).alias("message"))

    return run_outputs(tagged, "ad-clicks", {"counts": counts, "alerts": alerts})


def stream_ad_click_count(spark: SparkSession, d: str) -> DataFrame:
    """The ad-click program as one stream: passing clicks per province per 1 h window
    sliding by 5 s."""
    shares = _ad_clicks(spark, d)["counts"]
    return shares.groupBy("window_end", "province").agg(F.sum("n").alias("n")) \
        .select(_ntz("window_end"), "province", "n")


def stream_ad_click_alerts(spark: SparkSession, d: str) -> DataFrame:
    """The side output of the same stream: one alert per (user, ad) and day over the cap."""
    return _ad_clicks(spark, d)["alerts"]


STREAM_QUERIES = {
    "stream_word_count": stream_word_count,
    "stream_tumbling_sum": stream_tumbling_sum,
    "stream_tumbling_full": stream_tumbling_full,
    "stream_tumbling_avg": stream_tumbling_avg,
    "stream_sliding_count": stream_sliding_count,
    "stream_hot_pages": stream_hot_pages,
    "stream_hot_pages_timer": stream_hot_pages_timer,
    "stream_ad_click_count": stream_ad_click_count,
    "stream_ad_click_alerts": stream_ad_click_alerts,
    "stream_count_window_avg": stream_count_window_avg,
    "stream_count_window_sliding": stream_count_window_sliding,
    "stream_blacklist_pass": stream_blacklist_pass,
    "stream_blacklist_alerts": stream_blacklist_alerts,
    "stream_window_join": stream_window_join,
    "stream_log_word_count": stream_log_word_count,
    "stream_text_word_count": stream_text_word_count,
    "stream_resumed_sum": stream_resumed_sum,
    "stream_observed_count": stream_observed_count,
    "stream_late_rows": stream_late_rows,
}

# the batch query whose SQL each stream query must equal
SAME_AS = {
    "stream_log_word_count": "word_count",
    "stream_text_word_count": "word_count",
    "stream_resumed_sum": "tumbling_sum",
    "stream_hot_pages_timer": "stream_hot_pages",
    "stream_word_count": "word_count",
    "stream_tumbling_sum": "tumbling_sum",
    "stream_tumbling_full": "tumbling_full",
    "stream_tumbling_avg": "tumbling_avg",
    "stream_sliding_count": "sliding_count_expand",
    "stream_ad_click_count": "ad_click_count",
    "stream_ad_click_alerts": "ad_click_alerts",
    "stream_count_window_avg": "count_window_avg",
    "stream_count_window_sliding": "count_window_sliding",
    "stream_blacklist_pass": "blacklist_pass",
    "stream_blacklist_alerts": "blacklist_alerts",
    "stream_window_join": "window_join",
}

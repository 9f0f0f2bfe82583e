"""Registered queries on the driver tables: ``(spark, sf_dir) -> DataFrame``.

Each query maps one operator of the original programs onto the driver's
tables (the programs' own inputs are literals and missing log files) and
runs over the whole tables. Money is summed in integer cents so results
are exact and comparable with the SQL oracle.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.parsing import (parse_access_log, parse_ad_click, parse_int, parse_key_value,
                                 parse_order_line)
from ..functions.timefns import next_midnight
from ..operators import aggregates, clicks, count_windows, hot_pages as hp, joins, topn, windows
from ..operators.maps import map_with_setup
from ..operators.metrics import write_text_counting
from ..operators.window_fold import window_digest as _window_digest, window_median as _window_median
from ..operators.orders import order_amount as _order_amount
from ..operators.window_join import window_join as _window_join
from ..session import stable_path
from ..sinks.outputs import write_text
from ..sources.tables import table


def cents(col: str) -> Column:
    return F.round(F.col(col) * 100).cast("long")


def _events(spark, d):
    return table(spark, d, "events")


# -- windows ---------------------------------------------------------------

def sliding_count(spark: SparkSession, d: str) -> DataFrame:
    """Clicks per province per 1 h window sliding by 5 s (province = event_type); sweep form."""
    ev = _events(spark, d).select("ts", F.col("event_type").alias("province"))
    return (windows.sliding_count(ev, "ts", "1 hour", "5 seconds", ["province"], method="sweep")
            .select("window_end", "province", "n"))


def sliding_count_expand(spark: SparkSession, d: str) -> DataFrame:
    """Same operator, built-in expanding form (the streaming form), 1 h / 5 min."""
    ev = _events(spark, d).select("ts", F.col("event_type").alias("province"))
    return (windows.sliding_count(ev, "ts", "1 hour", "5 minutes", ["province"], method="expand")
            .select("window_end", "province", "n"))


def hot_pages(spark: SparkSession, d: str) -> DataFrame:
    """Top 3 urls (url = event_type) per 10 min window sliding by 5 s."""
    ev = _events(spark, d).select("ts", F.col("event_type").alias("url"))
    return hp.hot_pages(ev, "ts", "url", "10 minutes", "5 seconds", n=3)


def access_log_lines(spark: SparkSession, d: str) -> DataFrame:
    """Stand-in input: the driver has no access logs, so each event is written
    as one log line ``ip user - dd/MM/yyyy:HH:mm:ss zone method url`` (url =
    ``/`` + event_type). Formatting only; the query's work starts at parsing."""
    ev = _events(spark, d)
    line = F.concat_ws(" ", F.lit("10.0.0.1"), F.col("user_id").cast("string"), F.lit("-"),
                       F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"), F.lit("+0000"), F.lit("GET"),
                       F.concat(F.lit("/"), F.col("event_type")))
    return ev.select(line.alias("value"))


def hot_pages_log(spark: SparkSession, d: str) -> DataFrame:
    """The hot-page program end to end: parse access-log lines (time, url),
    count views per url per 10 min window sliding by 5 s, keep the top 3."""
    views = parse_access_log(access_log_lines(spark, d)).select("ts", "url")
    return hp.hot_pages(views, "ts", "url", "10 minutes", "5 seconds", n=3)


def tumbling_sum(spark: SparkSession, d: str) -> DataFrame:
    """Incremental sum of value cents per 1 h tumbling window over all events."""
    ev = _events(spark, d).select("ts", cents("value").alias("c"))
    return windows.tumbling_sum(ev, "ts", "1 hour", "c")


def tumbling_full(spark: SparkSession, d: str) -> DataFrame:
    """Whole-window statistics per 1 h tumbling window: count, sum, min, max of cents."""
    ev = _events(spark, d).select("ts", cents("value").alias("c"))
    return windows.window_agg(ev, "ts", "1 hour", [
        F.count(F.lit(1)).alias("n"), F.sum("c").alias("total"),
        F.min("c").alias("min_c"), F.max("c").alias("max_c")])


def tumbling_avg(spark: SparkSession, d: str) -> DataFrame:
    """Average value cents per 1 h tumbling window (double)."""
    ev = _events(spark, d).select("ts", cents("value").alias("c"))
    return windows.tumbling_avg(ev, "ts", "1 hour", "c")


def window_median(spark: SparkSession, d: str) -> DataFrame:
    """Median of value cents per 1 h tumbling window: a function over all rows of a window."""
    ev = _events(spark, d).select("ts", cents("value").alias("c"))
    return _window_median(ev, "ts", "1 hour", "c")


def window_digest(spark: SparkSession, d: str) -> DataFrame:
    """Per 1 h tumbling window, what depends on the order of its events: first and last
    cents, the checksum of positions times cents, the longest rise."""
    ev = _events(spark, d).select("ts", "event_id", cents("value").alias("c"))
    return _window_digest(ev, "ts", "1 hour", ["event_id"], "c")


def order_amount(spark: SparkSession, d: str) -> DataFrame:
    """Order count and total cents per day of order date."""
    o = table(spark, d, "orders").select("o_orderdate", cents("o_totalprice").alias("c"))
    return _order_amount(o, "o_orderdate", "c", "1 day")


# -- word count and running counts ------------------------------------------

def word_count(spark: SparkSession, d: str) -> DataFrame:
    """Words of every document line split on ',' (Java split rules), counted."""
    docs = table(spark, d, "documents").select("text")
    return aggregates.word_count(docs, "text", ",")


def running_word_count(spark: SparkSession, d: str) -> DataFrame:
    """Every word of every document line with its running count, in arrival order."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    return aggregates.running_word_count(docs, "text", "doc_id", ",")


def running_count(spark: SparkSession, d: str) -> DataFrame:
    """Per-row running count of events per event_type in event_id order."""
    ev = _events(spark, d).select("event_id", "event_type")
    return aggregates.running_count(ev, ["event_type"], ["event_id"], out="running")


def count_window_avg(spark: SparkSession, d: str) -> DataFrame:
    """Average of every 3 consecutive events (cents) per user, in event_id order."""
    ev = _events(spark, d).select("user_id", "event_id", cents("value").alias("c"))
    return count_windows.count_window_tumbling(ev, ["user_id"], ["event_id"], "c", size=3)


def count_window_sliding(spark: SparkSession, d: str) -> DataFrame:
    """Every 2 events per user, count and cents of that user's last 3 events."""
    ev = _events(spark, d).select("user_id", "event_id", cents("value").alias("c"))
    return count_windows.count_window_sliding(ev, ["user_id"], ["event_id"], every=2, size=3,
                                              value="c")


# -- joins -----------------------------------------------------------------

def _join_inputs(spark, d):
    """Two whole tables with ids that the other side lacks, on both sides."""
    marks = table(spark, d, "labels").select(
        F.col("doc_id").alias("id"), F.col("quality").cast("string").alias("quality"), "toxic")
    vectors = table(spark, d, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").cast("string").alias("cluster"))
    return marks, vectors


def join_inner(spark: SparkSession, d: str) -> DataFrame:
    """Document labels joined with the vectors of the same id."""
    return joins.equi_join(*_join_inputs(spark, d), "id", "inner")


def join_left(spark: SparkSession, d: str) -> DataFrame:
    """Left outer: labels without a vector get cluster "null"."""
    return joins.equi_join(*_join_inputs(spark, d), "id", "left")


def join_right(spark: SparkSession, d: str) -> DataFrame:
    """Right outer: vectors without labels get quality "null" (toxic stays NULL)."""
    return joins.equi_join(*_join_inputs(spark, d), "id", "right")


def join_full(spark: SparkSession, d: str) -> DataFrame:
    """Full outer of the two, id from whichever side exists."""
    return joins.equi_join(*_join_inputs(spark, d), "id", "full")


def broadcast_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Every customer looked up in a map user -> number of events; customers
    missing from the map give 0."""
    cust = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    seen = table(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"))
    return joins.lookup(cust, seen, "c_custkey", "user_id", "n_events", default=0)


def window_join(spark: SparkSession, d: str) -> DataFrame:
    """Clicks joined with purchases of the same user in the same 1 h tumbling window.

    The operator joins two streams; ``events`` is split into them by event type.
    """
    ev = _events(spark, d)
    click = ev.where(F.col("event_type") == "click").select(
        F.col("user_id").alias("k"), "ts", F.col("event_id").alias("v1"))
    buy = ev.where(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("k"), "ts", F.col("event_id").alias("v2"))
    return _window_join(click, buy, "k", "ts", "1 hour")


# -- first-n / top-n -------------------------------------------------------

def _orders(spark, d):
    return table(spark, d, "orders")


def first_n(spark: SparkSession, d: str) -> DataFrame:
    """First 3 orders in arrival (order key) order."""
    o = _orders(spark, d).select("o_orderkey", "o_custkey", "o_orderstatus")
    return topn.first_n(o, 3, ["o_orderkey"])


def group_first_n(spark: SparkSession, d: str) -> DataFrame:
    """First 2 orders of each customer in arrival order."""
    o = _orders(spark, d).select("o_custkey", "o_orderkey", "o_orderstatus")
    return topn.group_first_n(o, ["o_custkey"], 2, ["o_orderkey"])


def group_sorted_first(spark: SparkSession, d: str) -> DataFrame:
    """Each customer's cheapest order (ties by order key)."""
    o = _orders(spark, d).select("o_custkey", "o_orderkey", "o_totalprice")
    return topn.group_sorted_first(o, ["o_custkey"], ["o_totalprice", "o_orderkey"], 1)


def sort_limit(spark: SparkSession, d: str) -> DataFrame:
    """Sort by customer ascending, total price descending (order key breaks ties); first 3."""
    o = _orders(spark, d).select("o_custkey", "o_totalprice", "o_orderkey")
    return topn.sort_limit(o, [F.col("o_custkey").asc(), F.col("o_totalprice").desc(),
                               F.col("o_orderkey").asc()], 3)


# -- click cap, metrics, scalar --------------------------------------------

def _clicks(spark, d):
    return _events(spark, d).select("event_id", "user_id", F.col("event_type").alias("ad_id"),
                                    "ts")


BLACKLIST_CAP = 2  # the data has at most ~5 events per (user, type, day) at sf0.01


def blacklist_pass(spark: SparkSession, d: str) -> DataFrame:
    """Events that pass a cap of 2 per (user, event_type) and UTC day."""
    return clicks.click_pass(_clicks(spark, d), ["user_id", "ad_id"], "ts", ["event_id"],
                             cap=BLACKLIST_CAP, period="1 day")


def blacklist_alerts(spark: SparkSession, d: str) -> DataFrame:
    """One alert per (user, event_type) and UTC day that went over the cap."""
    return clicks.click_alerts(_clicks(spark, d), ["user_id", "ad_id"], "ts", ["event_id"],
                               cap=BLACKLIST_CAP, period="1 day")


def ad_click_lines(ev: DataFrame) -> DataFrame:
    """Stand-in input: the driver has no ad-click log, so each event is written as one
    line ``user,ad,province,city,epoch seconds``. Formatting only; the query's work
    starts at parsing. ``event_id`` (the arrival sequence) rides along."""
    line = F.concat_ws(",", F.col("user_id").cast("string"),
                       F.pmod("event_id", F.lit(3)).cast("string"), F.col("event_type"),
                       F.concat(F.lit("city"), F.pmod("user_id", F.lit(5)).cast("string")),
                       F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"))
    return ev.select("event_id", line.alias("value"))


def _ad_clicks(spark, d):
    return parse_ad_click(ad_click_lines(_events(spark, d)), extra=["event_id"])


def ad_click_count(spark: SparkSession, d: str) -> DataFrame:
    """The whole ad-click flow: parse click lines, cap clicks per (user, ad) and UTC
    day, then count the passing clicks per province per 1 h window sliding by 5 s."""
    passed = clicks.click_pass(_ad_clicks(spark, d), ["user_id", "ad_id"], "ts", ["event_id"],
                               cap=BLACKLIST_CAP, period="1 day")
    return (windows.sliding_count(passed.select("ts", "province"), "ts", "1 hour", "5 seconds",
                                  ["province"], method="sweep")
            .select("window_end", "province", "n"))


def ad_click_alerts(spark: SparkSession, d: str) -> DataFrame:
    """The ad-click flow's side output: one alert per (user, ad) and UTC day over the cap."""
    return clicks.click_alerts(_ad_clicks(spark, d), ["user_id", "ad_id"], "ts", ["event_id"],
                               cap=BLACKLIST_CAP, period="1 day")


# -- line parsers and the text sink ------------------------------------------

def parsed_ints(spark: SparkSession, d: str) -> DataFrame:
    """Events' cents as text lines, parsed as integers, counted per value."""
    lines = _events(spark, d).select(cents("value").cast("string").alias("value"))
    return parse_int(lines).groupBy("v").agg(F.count(F.lit(1)).alias("n"))


def parsed_key_values(spark: SparkSession, d: str) -> DataFrame:
    """Events as ``key,value`` lines with a surplus field, parsed, counted per pair."""
    line = F.concat_ws(",", F.col("user_id").cast("string"), F.col("event_type"), F.lit("more"))
    pairs = parse_key_value(_events(spark, d).select(line.alias("value")))
    return pairs.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))


def parsed_ad_clicks(spark: SparkSession, d: str) -> DataFrame:
    """Every ad-click line parsed into its five typed fields."""
    return _ad_clicks(spark, d).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def parsed_orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders as tab-separated lines (no payment reference: ``null``), parsed again."""
    o = _orders(spark, d)
    ref = F.when(F.col("o_orderstatus") == "O", F.lit("null")) \
        .otherwise(F.col("o_orderkey").cast("string"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    line = F.concat_ws("\t", F.col("o_orderkey").cast("string"),
                       cents("o_totalprice").cast("string"),
                       F.length("o_orderpriority").cast("string"),
                       F.col("o_custkey").cast("string"), F.col("o_orderpriority"), ref, day, day)
    parsed = parse_order_line(o.select(line.alias("value")))
    return parsed.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("create_time", "end_time")})


#: patterns of ``mapped_patterns``, by the column that counts their matches
PATTERNS = {"n_numbers": "[0-9]+", "n_names": "[A-Z][a-z]+", "n_commas": "[a-z] ?, ?[a-z]"}


def mapped_patterns(spark: SparkSession, d: str) -> DataFrame:
    """Matches of several patterns in every document, by a map whose setup compiles them once
    in each task; a null text has none."""
    def setup():
        return {name: re.compile(p) for name, p in PATTERNS.items()}

    def count(compiled, batch):
        text = batch["text"].fillna("")
        return pd.DataFrame({"doc_id": batch["doc_id"], **{
            name: text.map(lambda t, p=p: sum(1 for _ in p.finditer(t))).astype("int64")
            for name, p in compiled.items()}})

    docs = table(spark, d, "documents").select("doc_id", "text")
    return map_with_setup(docs, setup, count, "doc_id long, " + ", ".join(f"{n} long" for n in PATTERNS))


def text_lines_written(spark: SparkSession, d: str) -> DataFrame:
    """Labels joined with vectors (NULLs on both sides) written as text, read back as lines."""
    path = stable_path(spark, f"joined-text-{spark.sparkContext.applicationId}")
    write_text(joins.equi_join(*_join_inputs(spark, d), "id", "full"), path)
    return spark.read.text(path)


def next_midnight_q(spark: SparkSession, d: str) -> DataFrame:
    """For every event, the next UTC midnight after its time."""
    ev = _events(spark, d).select("event_id", "ts")
    return ev.withColumn("next_midnight", next_midnight("ts"))


def observed_count(spark: SparkSession, d: str) -> DataFrame:
    """Write lineitem as text lines and report the row count observed during the write."""
    li = table(spark, d, "lineitem")
    path = stable_path(spark, f"lineitem-text-{spark.sparkContext.applicationId}")
    n = write_text_counting(li, path)
    return spark.createDataFrame([(n,)], "n long")


QUERIES = {
    "sliding_count": sliding_count,
    "sliding_count_expand": sliding_count_expand,
    "hot_pages": hot_pages,
    "hot_pages_log": hot_pages_log,
    "tumbling_sum": tumbling_sum,
    "tumbling_full": tumbling_full,
    "tumbling_avg": tumbling_avg,
    "window_median": window_median,
    "window_digest": window_digest,
    "order_amount": order_amount,
    "word_count": word_count,
    "running_count": running_count,
    "running_word_count": running_word_count,
    "count_window_avg": count_window_avg,
    "count_window_sliding": count_window_sliding,
    "join_inner": join_inner,
    "join_left": join_left,
    "join_right": join_right,
    "join_full": join_full,
    "broadcast_lookup": broadcast_lookup,
    "window_join": window_join,
    "first_n": first_n,
    "group_first_n": group_first_n,
    "group_sorted_first": group_sorted_first,
    "sort_limit": sort_limit,
    "blacklist_pass": blacklist_pass,
    "blacklist_alerts": blacklist_alerts,
    "ad_click_count": ad_click_count,
    "ad_click_alerts": ad_click_alerts,
    "parsed_ints": parsed_ints,
    "parsed_key_values": parsed_key_values,
    "parsed_ad_clicks": parsed_ad_clicks,
    "parsed_orders": parsed_orders,
    "mapped_patterns": mapped_patterns,
    "text_lines_written": text_lines_written,
    "next_midnight": next_midnight_q,
    "observed_count": observed_count,
}

"""Top-n urls per sliding window (hot pages), batch form.

Count views per (url, window) over sliding windows, then keep the ``n``
largest counts of each window end, ties broken by url ascending (the
original leaves ties undefined). Fewer rows when a window has fewer urls.

The counts come as runs of windows with equal counts. Runs are cut at the
edges of time buckets and dealt by (bucket, salt of the url); a task expands its
pieces and ranks every window of its bucket at once, so of the expanded rows
only ``n`` per window and salt ever move.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.timefns import duration_micros, from_micros
from .windows import change_runs, cut_runs, spread, window_starts

SLIDES_PER_BUCKET = 720
SALTS = 8


def hot_pages(df: DataFrame, ts: str = "ts", url: str = "url", size: str = "10 minutes",
              slide: str = "5 seconds", n: int = 3) -> DataFrame:
    """``url, window_end, n`` (the view count), at most ``n`` rows per window end."""
    size_us, slide_us = duration_micros(size), duration_micros(slide)
    runs = change_runs(df.select(ts, F.col(url).alias("url")), ts, size_us, slide_us, ["url"], {})
    pieces = cut_runs(runs, slide_us, SLIDES_PER_BUCKET) \
        .withColumn("salt", F.pmod(F.xxhash64("url"), F.lit(SALTS)).cast("int"))
    rows = spread(pieces, "bucket", "salt").select(
        "bucket", "salt", "url", "n", window_starts(slide_us).alias("start"))
    # the exchange on (bucket, salt) already gathers what the first rank needs
    for group in (["bucket", "salt", "start"], ["start"]):
        best = Window.partitionBy(*group).orderBy(F.col("n").desc(), F.col("url").asc())
        rows = rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)
    return rows.select("url", from_micros(F.col("start") + F.lit(size_us)).alias("window_end"), "n")

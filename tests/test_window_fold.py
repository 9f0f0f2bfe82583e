"""Functions over all rows of a window, by fold: hot windows, ties, nulls, several batches."""

import datetime as dt
import random
import statistics
from collections import defaultdict

from riverbed.operators.window_fold import window_digest, window_median

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "id long, k string, ts timestamp_ntz, v long, _w long, n int"


def _rows(n=3000):
    r = random.Random(8)
    rows = [(i, r.choice(["a", "b", None]), T0 + dt.timedelta(seconds=r.choice([5, 5, 5, r.randint(0, 300)])),
             r.choice([7, r.randint(-40, 40)]), 1, 2) for i in range(n)]
    rows[0] = (0, "a", None, 3, 1, 2)
    rows[1] = (1, "a", T0, None, 1, 2)
    r.shuffle(rows)
    return rows


def _windows(rows):
    out = defaultdict(list)
    for i, k, ts, v, *_ in rows:
        if ts is not None and v is not None:
            out[k, ts.replace(second=0)].append((i, v))
    return out


def _rise(values):
    best = run = 1
    for a, b in zip(values, values[1:]):
        run = run + 1 if b >= a else 1
        best = max(best, run)
    return best


def test_median_and_digest_equal_the_gathered_window(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")    # windows span batches
    try:
        for span in (1, 16, 1 << 20):
            med = window_median(df, "ts", "1 minute", "v", ["k"], span=span).collect()
            dig = window_digest(df, "ts", "1 minute", ["id"], "v", ["k"], span=span).collect()
            want = _windows(rows)
            assert {(r.k, r.window_start): (r.n, r.median) for r in med} == {
                w: (len(x), statistics.median(v for _, v in x)) for w, x in want.items()}
            got = {(r.k, r.window_start): (r.n, r.first_v, r.last_v, r.checksum, r.longest_rise) for r in dig}
            assert len(dig) == len(got) == len(want)
            for w, x in want.items():
                v = [b for _, b in sorted(x)]
                assert got[w] == (len(v), v[0], v[-1], sum((i + 1) * b for i, b in enumerate(v)), _rise(v))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert window_median(df.limit(0), "ts", "1 minute", "v").collect() == []


def test_a_hot_window_is_dealt_over_tasks(spark):
    """One window with every row: no task gets more rows than a block and its header."""
    from pyspark.sql import functions as F
    from riverbed.operators import window_fold
    rows = spark.range(4000).select("id", F.lit(0).alias("_w"), F.floor(F.col("id") / 100).alias("_b"),
                                    F.col("id").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        laid = window_fold._blocks(rows, [], ["id"], window_fold.OrderedDigest("v"))
        blocks = laid.groupBy(F.spark_partition_id().alias("p"), "_b").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    # 40 blocks of 100 rows and a header row, over all 8 partitions
    assert {r["count"] for r in blocks} == {101} and len(blocks) == 40 and len({r["p"] for r in blocks}) == 8

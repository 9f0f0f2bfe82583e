"""Stream forms equal the batch forms when the input arrives in several micro-batches."""

import datetime as dt
import random

from pyspark.sql import functions as F

from riverbed.operators import clicks, count_windows, hot_pages, windows
from riverbed.operators.aggregates import word_count
from riverbed.operators.topn import top_n_per_group
from riverbed.sources.memory import stream_of, write_batches
from riverbed.streaming import operators as so
from riverbed.streaming.runner import run_available, run_outputs


def same(a, b, cols=None):
    cols = cols or a.columns
    a, b = a.select(cols), b.select(cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _chunks(rows, k):
    size = (len(rows) + k - 1) // k
    return [rows[i:i + size] for i in range(0, len(rows), size)]


def test_word_count_stream_over_batches(spark):
    lines = [("a,b,,",), ("b,c",), (",",), ("a",), ("c,a,b",)]
    schema = "value string"
    root = write_batches(spark, _chunks(lines, 3), schema, name="wc")
    got = run_available(word_count(stream_of(spark, root, schema), "value", ","), "wc",
                        "complete")
    want = word_count(spark.createDataFrame(lines, schema), "value", ",")
    assert same(got, want)


def _keyed(n=300, seed=5):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice([1, 1, 1, 2, 3]), rnd.randint(0, 99)) for i in range(n)]
    return rows


def test_count_windows_stream_over_batches(spark):
    rows = _keyed()
    batches = _chunks(rows, 4)
    for b in batches:  # arrival order inside a batch is not promised
        random.Random(1).shuffle(b)
    schema = "seq long, k long, v long"
    root = write_batches(spark, batches, schema, name="cw")
    src = stream_of(spark, root, schema)
    batch = spark.createDataFrame(rows, schema)

    got = run_available(so.count_window_avg_stream(src, ["k"], "seq", "v", 3), "cwa")
    assert same(got, count_windows.count_window_tumbling(batch, ["k"], ["seq"], "v", 3))

    src = stream_of(spark, root, schema)
    got = run_available(so.count_window_sliding_stream(src, ["k"], "seq", "v", 2, 3), "cws")
    assert same(got, count_windows.count_window_sliding(batch, ["k"], ["seq"], 2, 3, "v"))


def test_click_cap_stream_over_batches(spark):
    base = dt.datetime(2024, 1, 1, 23, 58)
    rows = [(i, 7, "ad", base + dt.timedelta(seconds=i)) for i in range(240)]  # spans midnight
    schema = "seq long, user_id long, ad_id string, ts timestamp_ntz"
    root = write_batches(spark, _chunks(rows, 5), schema, name="cap")
    src = so.event_time(stream_of(spark, root, schema), "ts", "10 seconds")
    got = run_available(so.click_cap_stream(src, ["user_id", "ad_id"], "ts", "seq", cap=50),
                        "cap")
    batch = clicks.click_cap(spark.createDataFrame(rows, schema), ["user_id", "ad_id"], "ts",
                             ["seq"], cap=50)
    cols = ["seq", "user_id", "ad_id", "tag"]
    assert same(got, batch, cols)
    assert got.where("tag = 'alert'").count() == 2  # one per day


def test_click_cap_late_row_counts_in_its_own_day(spark):
    """A row of the day before, late but within the watermark, comes after midnight rows."""
    at = lambda text: dt.datetime.fromisoformat("2024-01-" + text)
    batches = [
        [(0, 7, "ad", at("01 23:59:50")), (1, 7, "ad", at("01 23:59:51")),
         (2, 7, "ad", at("01 23:59:52")), (3, 7, "ad", at("02 00:00:00")),
         (4, 7, "ad", at("02 00:00:01"))],
        [(5, 7, "ad", at("01 23:59:59"))],
        [(6, 7, "ad", at("02 00:00:02"))]]
    schema = "seq long, user_id long, ad_id string, ts timestamp_ntz"
    root = write_batches(spark, batches, schema, name="cap-late")
    src = so.event_time(stream_of(spark, root, schema), "ts", "10 seconds")
    got = run_available(so.click_cap_stream(src, ["user_id", "ad_id"], "ts", "seq", cap=2),
                        "cap-late")
    assert {(r.seq, r.tag) for r in got.collect()} == {
        (0, "pass"), (1, "pass"), (2, "alert"), (3, "pass"), (4, "pass"), (6, "alert")}
    batch = clicks.click_cap(spark.createDataFrame(sum(batches, []), schema),
                             ["user_id", "ad_id"], "ts", ["seq"], cap=2)
    assert same(got, batch, ["seq", "user_id", "ad_id", "tag"])


def test_window_totals_are_exact_integers():
    import numpy as np
    from riverbed.streaming.stateful import _complete_windows
    totals, rest, start = _complete_windows(0, 0, np.array([2**53, 1, 0, 5]), 3)
    assert totals.tolist() == [2**53 + 1] and (rest, start) == (1, 3)


def test_streams_leave_out_rows_without_a_value(spark):
    data = [(0, 1, 3), (1, 1, None), (2, 1, 5), (3, 1, 4), (4, 1, 6)]
    schema = "seq long, k long, v long"
    root = write_batches(spark, _chunks(data, 2), schema, name="nulls")
    got = run_available(so.count_window_avg_stream(stream_of(spark, root, schema), ["k"], "seq", "v"),
                        "nulls")
    assert [(r.total, r.avg) for r in got.collect()] == [(12, 4.0)]


def test_named_run_resumes_and_counts_each_row_once(spark):
    """Stop between batches, start again under the same name: nothing twice, nothing lost."""
    import uuid
    name, schema = uuid.uuid4().hex, "value string"
    root = write_batches(spark, [[("a,b",)], [("b",)]], schema, name="resume")

    def run():
        return {r.word: r.n for r in run_available(
            word_count(stream_of(spark, root, schema), "value", ","), "resume", "update",
            keys=["word"], run=name).collect()}
    assert run() == {"a": 1, "b": 2}
    assert run() == {"a": 1, "b": 2}
    spark.createDataFrame([("b,c",)], schema).write.parquet(f"{root}/part-later")
    assert run() == {"a": 1, "b": 3, "c": 1}


def test_update_log_is_folded(spark, monkeypatch):
    from riverbed.streaming import runner
    monkeypatch.setattr(runner, "COMPACT_EVERY", 2)
    import uuid
    schema, name = "value string", uuid.uuid4().hex
    root = write_batches(spark, [[("a",)], [("a,b",)], [("b",)], [("a",)], [("c",)]], schema,
                         name="fold")
    got = run_available(word_count(stream_of(spark, root, schema), "value", ","), "fold", "update",
                        keys=["word"], run=name)
    assert {r.word: r.n for r in got.collect()} == {"a": 3, "b": 2, "c": 1}
    folder = runner.Folder(spark, f"{runner.run_folder(spark, 'fold', name)}/out")
    assert folder.ids("snapshot") == [3] and folder.ids("batch") == [4]


def test_one_run_gives_both_outputs(spark):
    base = dt.datetime(2024, 1, 1, 8)
    rows = [(i, 7, "ad", base + dt.timedelta(seconds=i)) for i in range(6)]
    schema = "seq long, user_id long, ad_id string, ts timestamp_ntz"
    root = write_batches(spark, _chunks(rows, 3), schema, name="both")
    src = so.event_time(stream_of(spark, root, schema), "ts", "10 seconds")
    tagged = so.click_cap_stream(src, ["user_id", "ad_id"], "ts", "seq", cap=3)
    out = run_outputs(tagged, "both", {t: (lambda b, t=t: b.where(F.col("tag") == t).select("seq"))
                                       for t in ("pass", "alert")})
    assert sorted(r.seq for r in out["pass"].collect()) == [0, 1, 2]
    assert [r.seq for r in out["alert"].collect()] == [3]


def test_late_row_is_dropped(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    sec = lambda s: t0 + dt.timedelta(seconds=s)
    schema = "ts timestamp_ntz, k string"
    batches = [[(sec(1), "a")], [(sec(100), "a")], [(sec(200), "a")],
               [(sec(2), "a")],  # behind the watermark (190 s) two batches later
               [(sec(100000), "a")]]  # far-future row: closes every earlier window
    root = write_batches(spark, batches, schema, name="late")
    src = so.event_time(stream_of(spark, root, schema), "ts", "10 seconds")
    agg = windows.window_agg(src, "ts", "10 seconds", [F.count(F.lit(1)).alias("n")], ["k"])
    got = {r.window_start.replace(tzinfo=None): r.n for r in run_available(agg, "late").collect()}
    assert got[dt.datetime(2024, 1, 1, 0, 0, 0)] == 1  # the late row did not count


def test_count_window_average_state_kinds(spark):
    from fixtures import KEYED_VALUES
    rows = [(i, k, v) for i, (k, v) in enumerate(KEYED_VALUES)] + \
        [(100 + i, 1 + i % 2, i) for i in range(20)]
    schema = "seq long, k long, v long"
    root = write_batches(spark, _chunks(rows, 4), schema, name="kinds")
    want = count_windows.count_window_tumbling(spark.createDataFrame(rows, schema), ["k"],
                                               ["seq"], "v", 3)
    for kind in ("list", "value", "map"):
        got = run_available(so.count_window_avg_stream(stream_of(spark, root, schema), ["k"],
                                                       "seq", "v", 3, state=kind), f"cw-{kind}")
        assert same(got, want), kind


def test_hot_pages_stream_equals_batch(spark):
    rnd = random.Random(4)
    t0 = dt.datetime(2024, 1, 1)
    rows = sorted((t0 + dt.timedelta(seconds=rnd.randint(0, 300)), rnd.choice("abcde"))
                  for _ in range(150))
    schema = "ts timestamp_ntz, url string"
    sentinel = [(t0 + dt.timedelta(days=1), "zz-end")]
    root = write_batches(spark, _chunks(rows, 3) + [sentinel, sentinel], schema, name="hot2")
    src = so.event_time(stream_of(spark, root, schema), "ts", "10 seconds")
    got = run_available(so.hot_pages_stream(src, "ts", "url", "1 minute", "5 seconds", 3, 2),
                        "hot2")
    got = top_n_per_group(got, ["window_end"], [F.col("n").desc(), F.col("url").asc()], 3)
    got = got.where(F.col("url") != "zz-end").withColumn(
        "window_end", F.col("window_end").cast("timestamp_ntz"))
    want = hot_pages.hot_pages(spark.createDataFrame(rows, schema), "ts", "url", "1 minute",
                               "5 seconds", 3)
    assert same(got, want, ["url", "window_end", "n"])


def test_click_cap_processing_time(spark):
    from riverbed.session import shared_path
    rows = [(i, 7, "ad", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i)) for i in range(12)]
    schema = "seq long, user_id long, ad_id string, ts timestamp_ntz"
    root = write_batches(spark, [rows], schema, name="cap-pt")
    src = stream_of(spark, root, schema).withColumn("ts", F.col("ts").cast("timestamp"))
    out = so.click_cap_stream(src, ["user_id", "ad_id"], "ts", "seq", cap=10,
                              processing_time=True)
    path, ckpt = shared_path(spark, "cap-pt-out"), shared_path(spark, "cap-pt-ckpt")
    q = (out.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    # a pending processing-time timer keeps the query alive (it never counts
    # as idle), so wait until the batch holding the input has committed
    import time
    deadline = time.time() + 120
    while time.time() < deadline and sum(p["numInputRows"] for p in q.recentProgress) < 12:
        time.sleep(0.5)
    q.stop()
    tags = sorted(r.tag for r in spark.read.schema(out.schema).parquet(path).collect())
    assert tags == ["alert"] + ["pass"] * 10


def test_processing_time_tumbling_window(spark):
    rows = [(str(i),) for i in range(10)]
    root = write_batches(spark, [rows[:5], rows[5:]], "value string", name="proc")
    src = so.with_processing_time(stream_of(spark, root, "value string"))
    ints = src.select("proc_ts", F.col("value").cast("int").alias("v"))
    agg = windows.window_agg(ints, "proc_ts", "10 seconds", [F.sum("v").alias("total")])
    got = run_available(agg, "proc", "update", keys=["window_start", "window_end"])
    assert got.agg(F.sum("total")).collect()[0][0] == sum(range(10))


def test_tagged_side_outputs_one_pass(spark):
    from riverbed.session import shared_path
    from riverbed.sinks.outputs import write_tagged_batch
    base = dt.datetime(2024, 1, 1, 8)
    rows = [(i, 7, "ad", base + dt.timedelta(seconds=i)) for i in range(5)]
    schema = "seq long, user_id long, ad_id string, ts timestamp_ntz"
    root = write_batches(spark, _chunks(rows, 2), schema, name="tags")
    src = so.event_time(stream_of(spark, root, schema), "ts", "10 seconds")
    tagged = so.click_cap_stream(src, ["user_id", "ad_id"], "ts", "seq", cap=3)
    out = {t: shared_path(spark, f"tag-{t}") for t in ("pass", "alert")}
    writers = {t: (lambda p: lambda b: b.write.mode("append").parquet(p))(p)
               for t, p in out.items()}
    q = (tagged.writeStream.foreachBatch(write_tagged_batch(writers))
         .option("checkpointLocation", shared_path(spark, "tags-ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert sorted(r.seq for r in spark.read.parquet(out["pass"]).collect()) == [0, 1, 2]
    assert [r.seq for r in spark.read.parquet(out["alert"]).collect()] == [3]


def test_stream_queries_replay_shuffled_part_files_in_event_order(spark, monkeypatch):
    """Part files written latest rows first, several micro-batches: equal to the batch twin."""
    from functools import partial

    from riverbed.plans import catalog, stream_catalog
    from riverbed.session import shared_path
    from riverbed.sources import tables
    n = 4000
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=37 * i), i % 3,
             ["click", "purchase", "view"][i * 7 % 5 % 3], i / 8, "{}") for i in range(n)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    d = shared_path(spark, "shuffled")
    for lo in (3000, 1000, 2000, 0):
        spark.createDataFrame(rows[lo:lo + 1000], schema).coalesce(1) \
            .write.mode("append").parquet(f"{d}/events.parquet")
    sizes = [s.getLen() for s in spark._jvm.org.apache.hadoop.fs.Path(d).getFileSystem(
        spark._jsc.hadoopConfiguration()).listStatus(
        spark._jvm.org.apache.hadoop.fs.Path(f"{d}/events.parquet"))]
    small = partial(tables.stream_table, max_bytes=sum(sizes) // 5)
    monkeypatch.setattr(stream_catalog, "_stream", small)
    for name in ("stream_tumbling_sum", "stream_count_window_avg", "stream_blacklist_pass",
                 "stream_ad_click_alerts", "stream_window_join"):
        want = getattr(catalog, stream_catalog.SAME_AS[name])
        if name == "stream_window_join":
            ev = tables.table(spark, d, "events")
            side = lambda kind, v: ev.where(F.col("event_type") == kind).select(
                F.col("user_id").alias("k"), F.date_trunc("hour", "ts").alias("h"),
                F.col("event_id").alias(v))
            want = side("click", "v1").join(side("purchase", "v2"), ["k", "h"]).select("k", "v1", "v2")
        else:
            want = want(spark, d)
        got = stream_catalog.STREAM_QUERIES[name](spark, d)
        assert want.count() and same(got, want, want.columns), name

"""Streams: hot keys in count windows, timers on a set clock, replayable lines, folded
outputs, idle sides, runs that stop and resume."""

import datetime as dt
import random
import time
import uuid
from contextlib import contextmanager

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from riverbed.operators import count_windows
from riverbed.plans import catalog, stream_catalog
from riverbed.session import shared_path
from riverbed.sources.line_log import Segments, append_lines, stream_line_log
from riverbed.sources.memory import stream_of, write_batches
from riverbed.sources.tables import replay
from riverbed.streaming import operators as so
from riverbed.streaming import runner, stateful

from test_streaming import same


def test_hot_key_is_cut_into_blocks(spark):
    """One key holds half of every micro-batch: it comes as blocks, none above the span, from
    many tasks, and the windows equal the batch form's."""
    r = random.Random(3)
    rows = [(i, 0 if i % 2 else r.randint(1, 40), r.randint(-9, 9)) for i in range(4000)]
    rows[5] = (5, None, 4)
    rows[7] = (7, 0, None)
    schema, span = "seq long, k long, v long", 100
    batches = [rows[:2100], rows[2100:]]
    for b in batches:
        r.shuffle(b)
    root = write_batches(spark, batches, schema, name="hot")
    blocks = so.value_blocks(spark.createDataFrame(rows, schema), ["k"], "seq", "v", span, 16)
    sizes = [(x["rb_k0"], len(x.vals)) for x in blocks.collect()]
    assert max(n for _, n in sizes) <= span and sum(k == "0" for k, _ in sizes) == 40
    task = F.pmod(F.xxhash64("rb_k0", "rb_n0", "block"), F.lit(16)).alias("t")
    tasks = blocks.where("rb_k0 = '0'").select(task).distinct()
    assert tasks.count() > 8
    batch = spark.createDataFrame(rows, schema)
    src = lambda: stream_of(spark, root, schema)
    for kind in ("list", "value", "map"):
        got = runner.run_available(so.count_window_avg_stream(src(), ["k"], "seq", "v", 3, state=kind, span=span),
                                   "hot-avg")
        assert same(got, count_windows.count_window_tumbling(batch, ["k"], ["seq"], "v", 3)), kind
    got = runner.run_available(so.count_window_sliding_stream(src(), ["k"], "seq", "v", 2, 3, span=span), "hot-sl")
    assert same(got, count_windows.count_window_sliding(batch, ["k"], ["seq"], 2, 3, "v"))


def test_processing_time_timer_resets_the_cap(spark):
    """The clock stands 20 s before midnight: the cap holds, the timer fires at midnight,
    clears the state, and the same key passes again."""
    schema = "seq long, user_id long, ad_id string, ts timestamp"
    rows = [(i, 7, "ad", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i)) for i in range(12)]
    root = write_batches(spark, [rows[:5]], schema, name="clock")
    day = 86_400_000
    clock = -(int(time.time() * 1000) % day) - 20_000       # engine time + clock = 20 s to midnight
    out = so.click_cap_stream(stream_of(spark, root, schema), ["user_id", "ad_id"], "ts", "seq", cap=3,
                              processing_time=True, clock_ms=clock, buckets=4)
    runner.use_rocksdb_state(spark)
    path = shared_path(spark, "clock-out")
    q = (out.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", shared_path(spark, "clock-ckpt")).trigger(processingTime="0 seconds").start())

    def wait(done):
        deadline = time.time() + 90
        while time.time() < deadline and not done():
            time.sleep(0.2)
        assert done(), q.lastProgress

    def state_rows():
        p = q.lastProgress
        return p["stateOperators"][0]["numRowsTotal"] if p else -1

    def read():
        return {(x.seq, x.tag): x.period_start for x in spark.read.schema(out.schema).parquet(path).collect()}

    def total():
        return sum(p["numInputRows"] for p in q.recentProgress)
    try:
        wait(lambda: total() >= 5)
        before_midnight = int(time.time() * 1000) + clock < 0 or (int(time.time() * 1000) + clock) % day > day - 20_000
        assert before_midnight
        assert sorted(read()) == [(0, "pass"), (1, "pass"), (2, "pass"), (3, "alert")]
        assert state_rows() == 1
        wait(lambda: state_rows() == 0)                     # the timer has fired
        spark.createDataFrame(rows[5:10], schema).coalesce(1).write.parquet(f"{root}/part-later")
        wait(lambda: total() >= 10)
        got = read()
        assert sorted(got) == [(0, "pass"), (1, "pass"), (2, "pass"), (3, "alert"),
                               (5, "pass"), (6, "pass"), (7, "pass"), (8, "alert")]
        assert got[5, "pass"] - got[0, "pass"] == dt.timedelta(days=1)
    finally:
        q.stop()


def test_line_log_gives_every_offset_once_over_restarts(spark):
    log, run = shared_path(spark, "log"), uuid.uuid4().hex
    read = lambda: runner.run_available(stream_line_log(spark, log), "log", run=run)
    odd = ["a,b", "", "tab\there", "back\\slash\\n", "two\nlines", "é日"]
    lines = spark.createDataFrame([(x,) for x in odd * 5], "value string").repartition(3)
    append_lines(lines, log, segment=4)
    assert sorted(r.value for r in read().collect()) == sorted(odd * 5)
    append_lines(spark.createDataFrame([("late",), (None,)], "value string").coalesce(1), log)
    # a segment still being written, and one behind a gap, are not read yet
    Segments(log).fs.open_output_stream(f"{Segments(log).root}/p=0/000000009000-000000009001.log.tmp").close()
    Segments(log).append(1, 500_000, ["after a gap"])
    rows = read().collect()
    assert sorted(r.value for r in rows) == sorted(odd * 5 + ["late", ""])
    assert len({(r.partition, r.offset) for r in rows}) == len(rows)
    assert read().count() == len(rows)


def test_outputs_are_folded(spark, monkeypatch):
    monkeypatch.setattr(runner, "COMPACT_EVERY", 2)
    schema, run = "v long", uuid.uuid4().hex
    root = write_batches(spark, [[(i,)] for i in range(7)], schema, name="folded")
    out = runner.run_outputs(stream_of(spark, root, schema), "folded",
                             {"even": lambda b: b.where("v % 2 = 0"), "all": lambda b: b}, run=run)
    assert sorted(r.v for r in out["all"].collect()) == list(range(7))
    assert sorted(r.v for r in out["even"].collect()) == [0, 2, 4, 6]
    folder = runner.Folder(spark, f"{runner.run_folder(spark, 'folded', run)}/out-all")
    assert folder.spans() == [(0, 3), (4, 5), (6, 6)]
    # folded folders left behind by a crash are not read twice
    folder.write(spark.createDataFrame([(0,)], schema), "batch", 0)
    assert folder.spans() == [(0, 3), (4, 5), (6, 6)]
    spark.createDataFrame([(7,)], schema).write.parquet(f"{root}/part-later")
    out = runner.run_outputs(stream_of(spark, root, schema), "folded",
                             {"even": lambda b: b.where("v % 2 = 0"), "all": lambda b: b}, run=run)
    assert sorted(r.v for r in out["all"].collect()) == list(range(8)) and folder.spans()[0] == (0, 7)


def test_join_with_an_idle_side(spark):
    """Two sources with watermarks of their own, one idle after its first rows. The policy
    ``min`` waits for it (state stays), ``max`` goes on (state is dropped); matches agree."""
    t0 = dt.datetime(2024, 1, 1)
    at = lambda s: t0 + dt.timedelta(seconds=s)
    schema = "k long, ts timestamp, {} long"
    busy = write_batches(spark, [[(1, at(s), s), (2, at(s), s)] for s in (0, 100, 200, 4000, 8000)],
                         schema.format("v1"), name="busy")
    idle = write_batches(spark, [[(1, at(30), 30), (1, at(150), 150)]], schema.format("v2"), name="idle")
    left = {}
    for policy in ("min", "max"):
        spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", policy)
        try:
            a = so.event_time(stream_of(spark, busy, schema.format("v1")), "ts")
            b = so.event_time(stream_of(spark, idle, schema.format("v2")), "ts")
            j = so.window_join_stream(a, b, "k", "ts", "1 minute")
            path = shared_path(spark, "idle-out")
            q = j.writeStream.format("parquet").option("path", path).option(
                "checkpointLocation", shared_path(spark, "idle-ckpt")).trigger(availableNow=True).start()
            assert q.awaitTermination(120)
            left[policy] = q.lastProgress["stateOperators"][0]["numRowsTotal"]
            got = {(r.k, r.v1, r.v2) for r in spark.read.schema(j.schema).parquet(path).collect()}
        finally:
            spark.conf.unset("spark.sql.streaming.multipleWatermarkPolicy")
        assert got == {(1, 0, 30)}
    assert left["max"] < left["min"]


def test_bounded_run_resumes(spark):
    schema, run = "v long", uuid.uuid4().hex
    root = write_batches(spark, [[(i, )] for i in range(6)], schema, name="bounded")
    src = lambda: stream_of(spark, root, schema).observe("o", F.count(F.lit(1)).alias("n"))
    _, first = runner.run_counting(src(), "bounded", run=run, batches=2)
    assert 2 <= first["observed"]["o.n"] <= 5
    out, totals = runner.run_counting(src(), "bounded", run=run)
    assert sorted(r.v for r in out.collect()) == list(range(6))
    assert totals["observed"] == {"o.n": 6} and totals["rows"] == 6


def test_replay_closes_the_last_windows(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(seconds=s), s) for s in (0, 5, 61, 130)]
    src = replay(spark.createDataFrame(rows, "ts timestamp, v int"), ["ts"], 0, close=("ts", "1 DAY"))
    src = so.open_rows(so.event_time(src, "ts"), "ts")
    assert src.columns == ["ts", "v"]
    agg = src.groupBy(F.window("ts", "1 minute").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    got = runner.run_available(agg, "closes").select("w.start", "n").collect()
    assert sorted((r.start.minute, r.n) for r in got) == [(0, 2), (1, 1), (2, 1)]
    empty = replay(spark.createDataFrame([], "ts timestamp, v int"), ["ts"], 0, close=("ts", "1 DAY"))
    assert runner.run_available(so.open_rows(so.event_time(empty, "ts"), "ts"), "closes").collect() == []


def test_blocks_come_in_order():
    import pandas as pd
    chunks = [pd.DataFrame({"block": [3, 1], "vals": [[7, 8], [1]]}), pd.DataFrame({"block": [2], "vals": [[4]]})]
    assert [v.tolist() for v in stateful._in_order(iter(chunks))] == [[1], [4], [7, 8]]
    assert pa.__version__


def _events_table(spark, rows):
    """An ``events`` table of ``(event_id, ts)`` rows; user, type and value follow the id."""
    d = shared_path(spark, "own-events")
    rows = [(i, ts, i % 7, "click", float(i), "") for i, ts in rows]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
                          "props string").coalesce(1).write.parquet(f"{d}/events.parquet")
    return d


@contextmanager
def _shuffle_partitions(spark, n):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, n)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def test_late_rows_come_in_few_micro_batches_and_meet_the_last_watermark(spark, monkeypatch):
    """The late row is ahead of all but the last of the others, so only the watermark of their
    last micro-batch shows that it is late."""
    t0, seen = dt.datetime(2024, 1, 1), []

    def counting(*args, **kwargs):
        kept, totals = runner.run_counting(*args, **kwargs)
        seen.append(totals)
        return kept, totals
    monkeypatch.setattr(stream_catalog, "run_counting", counting)
    main = [(51 + i + i // 49, t0 + dt.timedelta(minutes=i)) for i in range(147)]
    assert not any(i % 50 == 0 for i, _ in main)
    late = (50, t0 + dt.timedelta(minutes=145, seconds=30))
    d = _events_table(spark, [*main, late])
    with _shuffle_partitions(spark, 12):
        got = stream_catalog.stream_late_rows(spark, d).collect()
    assert [tuple(r) for r in got] == [(148, 147, 1)]
    assert 4 <= seen[0]["batch"] + 1 <= 8


def test_micro_batches_of_a_small_table_do_not_follow_the_shuffle_partitions(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(minutes=i)) for i in range(200)]
    d = _events_table(spark, rows)
    for partitions in (3, 12):
        with _shuffle_partitions(spark, partitions):
            out, totals = runner.run_counting(stream_catalog._in_files(spark, d), "few")
            assert 3 <= totals["batch"] + 1 <= 5, partitions
            assert sorted(r.event_id for r in out.select("event_id").collect()) == [i for i, _ in rows]
    with _shuffle_partitions(spark, 5):
        assert same(stream_catalog.stream_resumed_sum(spark, d), catalog.tumbling_sum(spark, d))


class _Stores(StreamingQueryListener):
    """The numbers of state stores of an operator, seen over micro-batches."""

    def __init__(self):
        self.seen, self.batches = set(), 0

    def onQueryProgress(self, event):
        self.batches += 1
        self.seen |= {o.numShufflePartitions for o in event.progress.stateOperators}

    def onQueryStarted(self, event):
        pass

    onQueryIdle = onQueryTerminated = onQueryStarted


@pytest.mark.parametrize("name", ["stream_resumed_sum", "stream_late_rows"])
def test_state_stores_of_several_micro_batches_do_not_follow_the_shuffle_partitions(spark, name):
    t0 = dt.datetime(2024, 1, 1)
    d = _events_table(spark, [(i, t0 + dt.timedelta(minutes=i)) for i in range(200)])
    query, want = stream_catalog.STREAM_QUERIES[name], {}
    most = max(stream_catalog.STORES, spark.sparkContext.defaultParallelism)
    for partitions in (3, 3 * most):
        stores = _Stores()
        spark.streams.addListener(stores)
        try:
            with _shuffle_partitions(spark, partitions):
                want[partitions] = sorted(tuple(r) for r in query(spark, d).collect())
                # the session's own number is as it was
                assert spark.conf.get("spark.sql.shuffle.partitions") == str(partitions)
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        finally:
            spark.streams.removeListener(stores)
        assert stores.batches >= 2 and stores.seen == {min(partitions, most)}
    assert want[3] == want[3 * most]
    if name == "stream_resumed_sum":
        assert same(query(spark, d), catalog.tumbling_sum(spark, d))


class _State:
    """Value, list and map state of one key in memory; counts the calls."""

    calls = 0

    def __init__(self):
        self.held = None

    def _call(self):
        _State.calls += 1

    def get(self):
        self._call()
        return self.held

    def put(self, rows):
        self._call()
        self.held = list(rows)

    update = put

    def clear(self):
        self._call()
        self.held = None

    def updateValue(self, k, v):
        self._call()
        self.held = {**(self.held or {}), k: v}

    def iterator(self):
        self._call()
        return iter((self.held or {}).items())


class _ListState(_State):
    def get(self):
        return super().get() or []


class _Handle:
    def getValueState(self, *_):
        return _State()

    def getListState(self, *_):
        return _ListState()

    getMapState = getValueState


@pytest.mark.parametrize("size", [1, 2, 3, 5])
def test_a_call_serves_all_keys_of_a_bucket(monkeypatch, size):
    """State calls follow the calls of a processor, not the keys; windows of every key go on
    over micro-batches in which it is absent, and over runs of blocks."""
    import pandas as pd
    monkeypatch.setattr(stateful, "RUN", 4)
    r = random.Random(size)
    names = ["rb_k0", "rb_n0"]
    history, batches = {}, []
    for b in range(6):
        blocks = []
        for k in r.sample(range(40), 25) if b else range(30):
            for j in range(r.randint(1, 3)):
                vals = [r.randint(-2**60, 2**60) for _ in range(r.randint(1, 4))]
                history.setdefault(k, []).extend(vals)
                blocks.append((str(k) if k else "", k == 0, 10 * b + j, vals))
        r.shuffle(blocks)
        batches.append([pd.DataFrame(blocks[i::2], columns=[*names, "block", "vals"]) for i in range(2)])
    key = lambda k: (str(k) if k else "", k == 0)

    def run(proc):
        proc.init(_Handle())
        _State.calls = 0
        out = [f for b in batches for f in proc.handleInputRows((0,), iter(b), None)]
        assert _State.calls <= len(batches) * (size + 5)
        return pd.concat(out)
    # totals may pass 64 bits: they wrap in both
    wrap = lambda x: (x + 2**63) % 2**64 - 2**63
    for kind in ("list", "value", "map"):
        got = run(stateful.CountWindowAverage(names, size, kind))
        want = [(*key(k), i // size + 1, size, wrap(sum(v[i:i + size])))
                for k, v in history.items() for i in range(0, len(v) - size + 1, size)]
        cols = [*names, "window_no", "n", "total"]
        assert sorted(got[cols].itertuples(index=False, name=None)) == sorted(want), kind
    got = run(stateful.CountTriggerEvictor(names, 2, size))
    want = [(*key(k), i, min(i, size), wrap(sum(v[max(0, i - size):i])))
            for k, v in history.items() for i in range(2, len(v) + 1, 2)]
    assert sorted(got[[*names, "rn", "n", "total"]].itertuples(index=False, name=None)) == sorted(want)

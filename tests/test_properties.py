"""Equalities between the scale-minded forms and their naive counterparts."""

import datetime as dt
import random

import pytest

from pyspark.sql import Window, functions as F

from riverbed.operators.count_windows import count_window_sliding, count_window_tumbling
from riverbed.operators.prefix import running_totals
from riverbed.operators.windows import sliding_count_expand, sliding_count_sweep


def _skewed(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        # a third of the rows on one key, some NULL keys, the rest spread
        k = "hot" if i % 3 == 0 else (None if i % 17 == 0 else f"k{rnd.randint(0, 40)}")
        data.append((i * 7 + rnd.randint(0, 6), k, rnd.randint(-50, 500)))
    return spark.createDataFrame(data, "seq long, k string, v long")


@pytest.mark.parametrize("span", [1, 500, 1 << 20])
def test_running_totals_equal_window(spark, span):
    df = _skewed(spark)
    got = running_totals(df, ["k"], ["seq"], count_col="rn", sums={"cum": "v"}, next_col="nx",
                         span=span)
    w = Window.partitionBy("k").orderBy("seq")
    want = df.select("*", F.row_number().over(w).alias("rn"),
                     F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"),
                     F.lead("seq").over(w).alias("nx"))
    cols = ["seq", "k", "v", "rn", "cum", "nx"]
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0
    assert want.select(cols).exceptAll(got.select(cols)).count() == 0


def _final_plan(spark, make):
    """The plan that ran, with broadcasts off."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = make()
        out.collect()
        return out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_rows_move_once_and_a_hot_key_is_cut(spark):
    df = _skewed(spark)
    plan = _final_plan(spark, lambda: running_totals(df, ["k"], ["seq"], sums={"cum": "v"}, span=1000))
    moves = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "Reused" not in x]
    # one exchange carries rows; the others carry a row per block (after a partial aggregate)
    assert sum("REPARTITION_BY_COL" in x for x in moves) == 1, plan
    assert plan.count("partial_count") == 1 and len(moves) <= 4, plan
    hot = df.where("k = 'hot'").select((F.floor(F.col("seq") / 1000)).alias("b")).distinct().count()
    assert hot > 10


def test_sliding_count_windows_share_the_exchange(spark):
    plan = _final_plan(spark, lambda: count_window_sliding(_skewed(spark), ["k"], ["seq"], 2, 3, "v",
                                                           span=1000))
    moved = [x for x in plan.splitlines() if "REPARTITION_BY_COL" in x and "Reused" not in x]
    assert len(moved) == 1 and "ReusedExchange" in plan, plan


@pytest.mark.parametrize("span", [3, 40, 1 << 20])
def test_count_windows_equal_window_frames(spark, span):
    df = _skewed(spark)
    w = Window.partitionBy("k").orderBy("seq")
    ranked = df.withColumn("rn", F.row_number().over(w))
    frame = w.rowsBetween(-2, 0)
    want = (df.select("k", F.row_number().over(w).alias("rn"),
                      F.count(F.lit(1)).over(frame).alias("n"),
                      F.sum("v").over(frame).alias("total"))
            .where(F.col("rn") % 2 == 0))
    got = count_window_sliding(df, ["k"], ["seq"], every=2, size=3, value="v", span=span)
    assert got.exceptAll(want.select(got.columns)).count() == 0
    assert want.select(got.columns).exceptAll(got).count() == 0

    want_t = (ranked.groupBy("k", (F.floor((F.col("rn") - 1) / 3) + 1).alias("window_no"))
              .agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"))
              .where("n = 3"))
    got_t = count_window_tumbling(df, ["k"], ["seq"], "v", 3, span=span).drop("avg")
    assert got_t.exceptAll(want_t.select(got_t.columns)).count() == 0
    assert want_t.select(got_t.columns).exceptAll(got_t).count() == 0


@pytest.mark.parametrize("kind", ["double", "decimal(12,3)", "int"])
@pytest.mark.parametrize("size", [1, 2, 5])
def test_sliding_count_windows_keep_fractions_over_block_edges(spark, kind, size):
    df = _skewed(spark).withColumn("v", ((F.col("v") * 4 + 1) / 8).cast(kind))
    w = Window.partitionBy("k").orderBy("seq")
    want = df.select("k", F.row_number().over(w).alias("rn"),
                     F.sum("v").over(w.rowsBetween(1 - size, 0)).alias("total")).where("rn % 2 = 0")
    got = count_window_sliding(df, ["k"], ["seq"], every=2, size=size, value="v", span=3)
    assert got.schema["total"].dataType.typeName() == want.schema["total"].dataType.typeName()
    as_rows = lambda x: sorted((str(r["k"]), r["rn"], float(r["total"])) for r in x.collect())
    assert as_rows(got) == as_rows(want)


@pytest.mark.parametrize("slides", [7, 1 << 16])
def test_sweep_equals_expand(spark, monkeypatch, slides):
    from riverbed.operators import windows as wmod
    monkeypatch.setattr(wmod, "SLIDES_PER_BLOCK", slides)
    monkeypatch.setattr(wmod, "SLIDES_PER_PIECE", slides)
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    data = [(base + dt.timedelta(seconds=rnd.randint(0, 4000), microseconds=rnd.randint(0, 999)),
             rnd.choice(["a", "a", "a", "b", "c"]), rnd.randint(0, 9)) for _ in range(400)]
    df = spark.createDataFrame(data, "ts timestamp_ntz, k string, v long")
    for size, slide in [("10 minutes", "5 seconds"), ("1 minute", "7 seconds"),
                        ("30 seconds", "30 seconds")]:
        a = sliding_count_sweep(df, "ts", size, slide, ["k"], sums={"s": "v"})
        b = sliding_count_expand(df, "ts", size, slide, ["k"], sums={"s": "v"})
        assert a.exceptAll(b).count() == 0, (size, slide)
        assert b.exceptAll(a).count() == 0, (size, slide)


def test_hot_pages_buckets_equal_plain_ranking(spark, monkeypatch):
    from riverbed.operators import hot_pages as hp
    rnd = random.Random(12)
    base = dt.datetime(2024, 1, 1)
    data = [(base + dt.timedelta(seconds=rnd.randint(0, 900)), f"u{min(rnd.randint(0, 30), 12)}")
            for _ in range(500)]
    df = spark.createDataFrame(data, "ts timestamp_ntz, url string")
    counts = sliding_count_expand(df, "ts", "1 minute", "5 seconds", ["url"])
    best = Window.partitionBy("window_end").orderBy(F.col("n").desc(), F.col("url").asc())
    want = counts.withColumn("r", F.row_number().over(best)).where("r <= 3") \
        .select("url", "window_end", "n")
    for slides in (5, 720):
        monkeypatch.setattr(hp, "SLIDES_PER_BUCKET", slides)
        got = hp.hot_pages(df, "ts", "url", "1 minute", "5 seconds", 3)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

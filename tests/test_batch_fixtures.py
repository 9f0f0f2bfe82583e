
import datetime as dt

from pyspark.sql import functions as F

from fixtures import AGES, CITIES, FIRSTN, KEYED_VALUES, LETTERS, NAMES, USERS
from riverbed.operators import clicks, count_windows, hot_pages, joins, topn
from riverbed.operators.aggregates import running_count, word_count
from riverbed.operators.metrics import write_text_counting
from riverbed.session import shared_path


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def _uc(spark, cities=CITIES):
    return (spark.createDataFrame(USERS, "id int, name string"),
            spark.createDataFrame(cities, "id int, city string"))


INNER = [(1, "zs", "beijing"), (2, "ls", "shanghai")]


def test_inner_join(spark):
    u, c = _uc(spark)
    assert rows(joins.equi_join(u, c, "id", "inner"), "id", "name", "city") == INNER


def test_outer_joins(spark):
    u, c = _uc(spark)
    left = joins.equi_join(u, c, "id", "left")
    right = joins.equi_join(u, c, "id", "right")
    full = joins.equi_join(u, c, "id", "full")
    assert rows(left, "id", "name", "city") == sorted(INNER + [(3, "ww", "null")])
    assert rows(right, "id", "name", "city") == sorted(INNER + [(4, "null", "guangzhou")])
    assert rows(full, "id", "name", "city") == sorted(
        INNER + [(3, "ww", "null"), (4, "null", "guangzhou")])


def test_null_city_on_matched_row_stays_null(spark):
    u, c = _uc(spark, [(1, "beijing"), (2, None), (4, "guangzhou")])
    got = rows(joins.equi_join(u, c, "id", "left"), "id", "name", "city")
    assert (2, "ls", None) in got and (3, "ww", "null") in got


def test_outer_joins_are_one_join_of_two_scans(spark):
    u, c = _uc(spark)
    for how in ("left", "right", "full"):
        plan = joins.equi_join(u, c, "id", how)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join ") == 1, plan


def test_lookup_default(spark):
    probe = spark.createDataFrame([(n,) for n in NAMES], "name string")
    dim = spark.createDataFrame(AGES, "name string, age int")
    got = rows(joins.lookup(probe, dim, "name", "name", "age", default=0), "name", "age")
    assert got == [("ls", 20), ("ww", 17), ("zl", 0), ("zs", 18)]


def test_lookup_last_entry_wins(spark):
    probe = spark.createDataFrame([("zs",)], "name string")
    dim = spark.createDataFrame([("zs", 1, 0), ("zs", 2, 1)], "name string, age int, seq int")
    got = joins.lookup(probe, dim, "name", "name", "age", order="seq").collect()
    assert got[0]["age"] == 2


def _firstn(spark):
    return spark.createDataFrame([(i, k, n) for i, (k, n) in enumerate(FIRSTN)],
                                 "seq long, k int, name string")


def test_first_n(spark):
    got = topn.first_n(_firstn(spark), 3, ["seq"]).collect()
    assert [(r.k, r.name) for r in got] == [(2, "zs"), (4, "ls"), (3, "ww")]


def test_group_first_n_keeps_all(spark):
    got = rows(topn.group_first_n(_firstn(spark), ["k"], 2, ["seq"]), "k", "name")
    assert got == sorted(FIRSTN)


def test_group_sorted_first(spark):
    got = rows(topn.group_sorted_first(_firstn(spark), ["k"], ["name"], 1), "k", "name")
    assert got == [(2, "zl"), (3, "ww"), (4, "ls"), (7, "ly"), (8, "ce"), (9, "sq")]


def test_sort_limit(spark):
    got = topn.sort_limit(_firstn(spark), [F.col("k").asc(), F.col("name").desc()], 3).collect()
    assert [(r.k, r.name) for r in got] == [(2, "zs"), (2, "zl"), (3, "ww")]


def test_group_limit_is_pushed_below_the_shuffle(spark):
    df = topn.group_first_n(spark.range(1000).withColumn("k", F.col("id") % 3), ["k"], 2, ["id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    # cut in every task before the one exchange, then per group
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange hashpartitioning") == 1
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_observed_counter(spark):
    df = spark.createDataFrame([(x,) for x in LETTERS], "value string")
    assert write_text_counting(df, shared_path(spark, "letters")) == 8


def test_count_window_average_of_three(spark):
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(KEYED_VALUES)],
                               "seq long, k long, v long")
    got = rows(count_windows.count_window_tumbling(df, ["k"], ["seq"], "v", 3), "k", "avg")
    assert got == [(1, 13 / 3), (2, 14 / 3)]


def test_rows_without_a_value_belong_to_no_count_window(spark):
    data = [(0, 1, 3), (1, 1, None), (2, 1, 5), (3, 1, 4), (4, 1, 6)]
    df = spark.createDataFrame(data, "seq long, k long, v long")
    got = count_windows.count_window_tumbling(df, ["k"], ["seq"], "v", 3).collect()
    assert [(r.total, r.avg) for r in got] == [(12, 4.0)]
    got = count_windows.count_window_sliding(df, ["k"], ["seq"], 2, 3, "v").orderBy("rn").collect()
    assert [(r.rn, r.n, r.total) for r in got] == [(2, 2, 8), (4, 3, 15)]


def test_count_window_every_two_last_three(spark):
    df = spark.createDataFrame([(i, "a") for i in range(7)], "seq long, word string")
    got = count_windows.count_window_sliding(df, ["word"], ["seq"], every=2, size=3)
    assert [r.total for r in got.orderBy("rn").collect()] == [2, 3, 3]


def test_word_count_split_rule(spark):
    df = spark.createDataFrame([("a,b,,",), (",",), ("",), ("a",)], "value string")
    # each value is one line: "" is an empty word, "," none, "a,b,," two
    got = rows(word_count(df, "value", ",", by_lines=False), "word", "n")
    assert got == [("", 1), ("a", 2), ("b", 1)]
    # as texts cut into lines, an empty text has no line at all
    got = rows(word_count(df, "value", ",", by_lines=True), "word", "n")
    assert got == [("a", 2), ("b", 1)]


def test_running_count_per_row(spark):
    df = spark.createDataFrame([(i, w) for i, w in enumerate("a b a a b".split())],
                               "seq long, word string")
    got = [r.running for r in running_count(df, ["word"], ["seq"]).orderBy("seq").collect()]
    assert got == [1, 1, 2, 3, 2]


def _clicks(spark, n_first_day, n_next_day):
    base = dt.datetime(2024, 1, 1, 8)
    data = [(i, 7, 9, base + dt.timedelta(seconds=i)) for i in range(n_first_day)]
    data += [(10_000 + i, 7, 9, base + dt.timedelta(days=1, seconds=i)) for i in range(n_next_day)]
    return spark.createDataFrame(data, "seq long, user_id long, ad_id long, ts timestamp_ntz")


def test_click_cap_102_clicks(spark):
    df = _clicks(spark, 102, 1)
    passed = clicks.click_pass(df, ["user_id", "ad_id"], "ts", ["seq"], cap=100)
    alerts = clicks.click_alerts(df, ["user_id", "ad_id"], "ts", ["seq"], cap=100).collect()
    assert passed.count() == 101  # 100 on day one, 1 the next day
    assert len(alerts) == 1
    assert alerts[0].message == "点击超过100 次"
    assert alerts[0].period_start == dt.datetime(2024, 1, 1)


def test_click_cap_above_the_group_limit_threshold(spark):
    df = _clicks(spark, 1103, 0)
    passed = clicks.click_pass(df, ["user_id", "ad_id"], "ts", ["seq"], cap=1100)
    alerts = clicks.click_alerts(df, ["user_id", "ad_id"], "ts", ["seq"], cap=1100)
    assert passed.count() == 1100 and alerts.count() == 1


def _views(spark, data):
    return spark.createDataFrame(data, "ts timestamp_ntz, url string")


def test_hot_pages_ties_and_fewer(spark):
    t = dt.datetime(2024, 1, 1, 0, 0, 1)
    tied = _views(spark, [(t, u) for u in ("/d", "/c", "/b", "/a")])
    got = hot_pages.hot_pages(tied, "ts", "url", "10 seconds", "5 seconds", n=3)
    per_end = {}
    for r in got.collect():
        per_end.setdefault(r.window_end, []).append(r.url)
    assert all(sorted(v) == ["/a", "/b", "/c"] for v in per_end.values())
    two = _views(spark, [(t, "/a"), (t, "/b")])
    got = hot_pages.hot_pages(two, "ts", "url", "10 seconds", "5 seconds", n=3)
    assert got.count() == 4  # two windows hold the time, two urls each


def test_window_join_pairs_in_same_window(spark):
    from riverbed.operators.window_join import window_join
    t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    a = spark.createDataFrame([("k1", t(1), "a1"), ("k1", t(25), "a2"), ("k2", t(3), "a3")],
                              "k string, ts timestamp_ntz, v1 string")
    b = spark.createDataFrame([("k1", t(5), "b1"), ("k1", t(19), "b2"), ("k2", t(21), "b3")],
                              "k string, ts timestamp_ntz, v2 string")
    got = rows(window_join(a, b, "k", "ts", "20 seconds"), "k", "v1", "v2")
    assert got == [("k1", "a1", "b1"), ("k1", "a1", "b2")]


def test_rows_without_time_fall_in_no_window(spark):
    from riverbed.operators.windows import sliding_count_expand, sliding_count_sweep
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), "a"), (None, "a")],
                               "ts timestamp_ntz, k string")
    for f in (sliding_count_expand, sliding_count_sweep):
        got = f(df, "ts", "10 seconds", "5 seconds", ["k"]).collect()
        assert sorted(r.n for r in got) == [1, 1]


def test_counted_write_replaces_previous_output(spark):
    from riverbed.session import stable_path
    path = stable_path(spark, "counted-twice")
    df = spark.createDataFrame([(x,) for x in LETTERS], "value string")
    assert write_text_counting(df, path) == 8
    assert write_text_counting(df.limit(3), path) == 3
    assert spark.read.text(path).count() == 3

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riverbed.functions import parsing
from riverbed.functions.text import java_split, text_lines
from riverbed.functions.timefns import next_midnight


def _split(spark, s, sep=","):
    return spark.createDataFrame([(s,)], "s string").select(java_split("s", sep).alias("a")) \
        .collect()[0]["a"]


@pytest.mark.parametrize("line,expected", [
    ("", [""]),
    (",", []),
    (",,,", []),
    (",a", ["", "a"]),
    ("a,,b", ["a", "", "b"]),
    ("a,", ["a"]),
    ("a,b,,", ["a", "b"]),
    (",,a,,", ["", "", "a"]),
    ("abc", ["abc"]),
])
def test_java_split_edges(spark, line, expected):
    assert _split(spark, line) == expected


def test_java_split_space(spark):
    assert _split(spark, "a b  c ", " ") == ["a", "b", "", "c"]


def test_text_lines(spark):
    texts = ["a\nb\n", "", "x", "a\n\n", "a\r\nb\r\n", "a\rb"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(text_lines("t")).collect()]
    assert got == [["a", "b"], [], ["x"], ["a", ""], ["a", "b"], ["a\rb"]]


def test_parse_int_fail_and_drop(spark):
    df = spark.createDataFrame([("1",), ("x",), ("3",)], "value string")
    assert [r.v for r in parsing.parse_int(df, on_error="drop").collect()] == [1, 3]
    with pytest.raises(Exception):
        parsing.parse_int(df, on_error="fail").collect()


@pytest.mark.parametrize("text", [" 7 ", "", "1.0", "+", "99999999999"])
def test_parse_int_rejects_what_java_rejects(spark, text):
    df = spark.createDataFrame([(text,), ("+5",)], "value string")
    assert [r.v for r in parsing.parse_int(df, on_error="drop").collect()] == [5]
    with pytest.raises(Exception):
        parsing.parse_int(df, on_error="fail").collect()


def test_trailing_empty_fields_are_missing(spark):
    df = spark.createDataFrame([("k,",)], "value string")
    assert parsing.parse_key_value(df, on_error="drop").count() == 0
    with pytest.raises(Exception):
        parsing.parse_key_value(df, on_error="fail").collect()


def test_parse_key_value(spark):
    df = spark.createDataFrame([("a,1",), ("b,2,extra",), ("c",)], "value string")
    got = [(r.k, r.v) for r in parsing.parse_key_value(df, on_error="drop").collect()]
    assert got == [("a", "1"), ("b", "2")]
    with pytest.raises(Exception):
        parsing.parse_key_value(df, on_error="fail").collect()


def test_parse_ad_click(spark):
    df = spark.createDataFrame([(" 7 , 9 ,beijing, haidian ,1600000000",)], "value string")
    r = parsing.parse_ad_click(df).collect()[0]
    assert (r.user_id, r.ad_id, r.province, r.city) == (7, 9, "beijing", "haidian")
    assert r.ts == dt.datetime(2020, 9, 13, 12, 26, 40)


def test_parse_access_log(spark):
    line = "83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /presentations/logstash"
    r = parsing.parse_access_log(spark.createDataFrame([(line,)], "value string")).collect()[0]
    assert (r.ip, r.user_id, r.method, r.url) == ("83.149.9.216", "-", "GET",
                                                  "/presentations/logstash")
    assert r.ts == dt.datetime(2015, 5, 17, 10, 5, 3)


def test_next_midnight(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0),),
                                (dt.datetime(2024, 1, 1, 23, 59, 59),)], "ts timestamp_ntz")
    got = [r[0] for r in df.select(next_midnight("ts")).collect()]
    assert got == [dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2)]


def test_order_file(spark, tmp_path):
    from fixtures import ORDER_LINES
    from riverbed.sources.orders_file import read_orders
    p = tmp_path / "order_test"
    p.write_text("\n".join(ORDER_LINES) + "\n")
    df = read_orders(spark, str(p))
    rows = df.collect()
    assert len(rows) == 12
    assert df.agg(F.sum("amount")).collect()[0][0] == 871010
    assert rows[0].payment_ref is None and rows[2].payment_ref == 6239707419
    assert rows[9].channel == ""
    assert rows[10].end_time < rows[10].create_time


def _java_split_model(s: str, sep: str) -> list[str]:
    # Java String.split(sep), limit 0: no match -> [s]; else split and drop
    # trailing empty strings
    if sep not in s:
        return [s]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_java_split_random_strings(spark):
    import random
    rnd = random.Random(11)
    cases = ["".join(rnd.choice("ab,,") for _ in range(rnd.randint(0, 8))) for _ in range(300)]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    got = [r[0] for r in df.select(java_split("s", ",")).collect()]
    assert got == [_java_split_model(c, ",") for c in cases]

"""Line parsers (batch and stream alike; they are plain column expressions).

``on_error="fail"`` keeps Java's behaviour: a bad number or a missing
field stops the job (Spark's ANSI casts and array indexing throw).
Fields are cut as Java's ``split`` does, so trailing empty fields are missing.
``on_error="drop"`` uses ``try_cast`` / ``try_element_at`` and removes the
rows that did not parse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .text import java_split

# The access-log time pattern and the field positions of the
# two log formats, as the programs read them.
ACCESS_LOG_TIME_PATTERN = "dd/MM/yyyy:HH:mm:ss"
ACCESS_LOG_FIELDS = {"ip": 0, "user_id": 1, "time": 3, "method": 5, "url": 6}
AD_CLICK_FIELDS = ("user_id", "ad_id", "province", "city", "ts")


def _cast(c: Column, to: str, on_error: str) -> Column:
    if on_error == "fail":
        return c.cast(to)
    if on_error == "drop":
        return c.try_cast(to)
    raise ValueError("on_error must be 'fail' or 'drop'")


def _field(arr: Column, i: int, on_error: str) -> Column:
    # 1-based element_at throws on a short array under ANSI; try_ variant gives NULL.
    return F.element_at(arr, i + 1) if on_error == "fail" else F.try_element_at(arr, F.lit(i + 1))


def _finish(df: DataFrame, required: list[str], on_error: str) -> DataFrame:
    if on_error == "drop":
        cond = None
        for c in required:
            cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
        df = df.where(cond)
    return df


def parse_int(df: DataFrame, line: str = "value", out: str = "v", on_error: str = "fail") -> DataFrame:
    """One integer per line (``Integer.valueOf``: digits with an optional sign, no blanks)."""
    text = F.col(line)
    bad = (F.raise_error(F.concat(F.lit("not an integer: "), F.coalesce(text, F.lit("null"))))
           if on_error == "fail" else F.lit(None)).cast("int")
    value = F.when(text.rlike(r"\A[+-]?[0-9]+\z"), _cast(text, "int", on_error)).otherwise(bad)
    return _finish(df.select(value.alias(out)), [out], on_error)


def parse_key_value(df: DataFrame, line: str = "value", on_error: str = "fail",
                    extra: list[str] | None = None) -> DataFrame:
    """``key,value`` lines; extra fields ignored, a missing one fails (or drops)."""
    parts = java_split(line, ",")
    out = df.select(*(extra or []), _field(parts, 0, on_error).alias("k"),
                    _field(parts, 1, on_error).alias("v"))
    return _finish(out, ["k", "v"], on_error)


def parse_ad_click(df: DataFrame, line: str = "value", on_error: str = "fail",
                   extra: list[str] | None = None) -> DataFrame:
    """``user,ad,province,city,epoch_seconds``, each field trimmed."""
    p = java_split(line, ",")
    f = lambda i: F.trim(_field(p, i, on_error))
    out = df.select(
        *(extra or []),
        _cast(f(0), "long", on_error).alias("user_id"),
        _cast(f(1), "long", on_error).alias("ad_id"),
        f(2).alias("province"),
        f(3).alias("city"),
        F.timestamp_seconds(_cast(f(4), "long", on_error)).alias("ts"),
    )
    return _finish(out, ["user_id", "ad_id", "ts"], on_error)


def parse_access_log(df: DataFrame, line: str = "value", on_error: str = "fail") -> DataFrame:
    """Space-separated access log: ip, user, time (field 3), method (5), url (6).

    The time is read in the session time zone (UTC here) instead of the
    JVM default zone; field 4 (the zone text) is ignored as in the original.
    """
    p = java_split(line, " ")
    f = lambda name: F.trim(_field(p, ACCESS_LOG_FIELDS[name], on_error))
    when = (F.to_timestamp(f("time"), ACCESS_LOG_TIME_PATTERN) if on_error == "fail"
            else F.try_to_timestamp(f("time"), F.lit(ACCESS_LOG_TIME_PATTERN)))
    out = df.select(f("ip").alias("ip"), f("user_id").alias("user_id"), when.alias("ts"),
                    f("method").alias("method"), f("url").alias("url"))
    return _finish(out, ["ts", "url"], on_error)


# Inferred names of the 8 tab-separated order fields (nothing in the programs
# names them); the text "null" marks a missing payment reference.
ORDER_FIELDS = ("order_id", "amount", "category", "user_id", "channel", "payment_ref",
                "create_time", "end_time")
ORDER_SCHEMA = ("order_id long, amount long, category int, user_id long, channel string, "
                "payment_ref long, create_time timestamp, end_time timestamp")


def parse_order_line(df: DataFrame, line: str = "value", on_error: str = "fail") -> DataFrame:
    """Tab-separated order rows; empty channel stays empty, ``null`` -> NULL."""
    p = java_split(line, "\t")
    f = lambda i: _field(p, i, on_error)
    ref = f(5)
    out = df.select(
        _cast(f(0), "long", on_error).alias("order_id"),
        _cast(f(1), "long", on_error).alias("amount"),
        _cast(f(2), "int", on_error).alias("category"),
        _cast(f(3), "long", on_error).alias("user_id"),
        f(4).alias("channel"),
        _cast(F.when(ref == F.lit("null"), F.lit(None)).otherwise(ref), "long", on_error)
        .alias("payment_ref"),
        _cast(f(6), "timestamp", on_error).alias("create_time"),
        _cast(f(7), "timestamp", on_error).alias("end_time"),
    )
    return _finish(out, ["order_id", "amount", "create_time"], on_error)

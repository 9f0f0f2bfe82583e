"""The tab-separated order file (8 fields per line, see functions.parsing)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.parsing import parse_order_line


def read_orders(spark: SparkSession, path: str, on_error: str = "fail") -> DataFrame:
    return parse_order_line(spark.read.text(path), "value", on_error)

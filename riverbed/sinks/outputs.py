"""Sinks: text files, console/memory for inspection, and tagged side outputs."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F


def text_line(df: DataFrame, sep: str = ",") -> Column:
    """A row's fields joined by ``sep``; a NULL field is written as ``null``, so no
    column shifts."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("null"))
                              for c in df.columns]).alias("value")


def write_text(df: DataFrame, path: str, sep: str = ",") -> None:
    """Every row as one text line, overwriting ``path``."""
    df.select(text_line(df, sep)).write.mode("overwrite").text(path)


def show(df: DataFrame, n: int = 20) -> None:
    """Print result rows (batch)."""
    df.show(n, truncate=False)


def split_tagged(df: DataFrame, tag_col: str = "tag") -> Callable[[str], DataFrame]:
    """One pass, several outputs: ``split_tagged(df)("alert")`` selects one tag."""
    return lambda tag: df.where(F.col(tag_col) == tag).drop(tag_col)


def write_tagged_batch(writers: Mapping[str, Callable[[DataFrame], None]], tag_col: str = "tag"
                       ) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: persist the micro-batch once, hand each tag's rows
    to its writer, release. Keeps one pass over the input for all outputs."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()
        try:
            for tag, write in writers.items():
                write(batch.where(F.col(tag_col) == tag).drop(tag_col))
        finally:
            batch.unpersist()
    return run


def print_stream(df: DataFrame, output_mode: str = "append", checkpoint: str | None = None,
                 truncate: bool = False):
    """Print every micro-batch's result rows (``.print()`` of a stream); returns the
    started query. For inspection only: the console sink keeps nothing."""
    w = df.writeStream.format("console").outputMode(output_mode).option("truncate", truncate)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.start()

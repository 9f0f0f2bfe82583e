"""Word counts and keyed running counts.

The original emits a new running total for every input row. Two batch
forms cover it: the final totals (``word_count``: one row per word, the
last value each key reaches) and the per-row log (``running_count``:
every row with the running total at that row).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import split_trimmed, strip_trailing, text_lines
from .prefix import SPAN, running_totals


def words(df: DataFrame, text: str = "value", sep: str = ",", by_lines: bool = True,
          keep: Sequence[str] = ()) -> DataFrame:
    """``(word, one)`` rows: each line split with Java ``split`` semantics.

    With ``by_lines`` a multi-line text is first cut into lines, as a line
    source would deliver it; every line is then split on ``sep``.
    """
    src = F.col(text)
    if by_lines:
        df = df.select(*keep, F.explode(text_lines(src)).alias("_line"))
        src = F.col("_line")
    # the trailing-separator regex runs once per line, in a projection
    trimmed = df.select(*keep, src.alias("_l"), strip_trailing(src, sep).alias("_t"))
    return trimmed.select(*keep, F.explode(split_trimmed("_l", "_t", sep)).alias("word"),
                          F.lit(1).alias("one"))


def word_count(df: DataFrame, text: str = "value", sep: str = ",", by_lines: bool = True
               ) -> DataFrame:
    """``word, n``: final running count per word. Partial aggregation runs
    map-side, so a very frequent word costs one row per task in the shuffle."""
    return (words(df, text, sep, by_lines)
            .groupBy("word").agg(F.sum("one").cast("long").alias("n")))


def running_word_count(df: DataFrame, text: str, doc: str, sep: str = ",",
                       out: str = "n", span: int = 1 << 12) -> DataFrame:
    """The per-word log of a running word count: every word of every line,
    in arrival order ``(doc, line_no, pos)``, with the count of that word so
    far. Lines and positions are 0-based. Hot words are cut into blocks of
    ``span`` consecutive doc ids by ``running_totals``."""
    lines = df.select(doc, F.posexplode(text_lines(F.col(text))).alias("line_no", "_l"))
    trimmed = lines.select(doc, F.col("line_no").cast("long").alias("line_no"), "_l",
                           strip_trailing(F.col("_l"), sep).alias("_t"))
    words = trimmed.select(doc, "line_no",
                           F.posexplode(split_trimmed("_l", "_t", sep)).alias("pos", "word"))
    words = words.withColumn("pos", F.col("pos").cast("long"))
    return running_totals(words, ["word"], [doc, "line_no", "pos"], count_col=out, span=span)


def running_count(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  value: str | Column | None = None, out: str = "running",
                  span: int = SPAN) -> DataFrame:
    """Every row plus its key's running count (or running sum of ``value``).

    ``order`` is the arrival sequence and must be unique within a key.
    """
    if value is None:
        return running_totals(df, keys, order, count_col=out, span=span)
    v = F.col(value) if isinstance(value, str) else value
    return running_totals(df, keys, order, count_col=None, sums={out: v}, span=span)

"""Job-level side metrics (the accumulator counterpart).

``df.observe`` computes named aggregates while the rows flow to a sink, in
the same job; the values are read after the action. Unlike a per-task
counter they are merged across tasks, so the number is the global one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from ..sinks.outputs import text_line


def write_text_counting(df: DataFrame, path: str, sep: str = ",") -> int:
    """Write ``df`` as text lines (fields joined by ``sep``, overwrite) and
    return the number of rows written, observed during the write."""
    obs = Observation("rows_written")
    df.observe(obs, F.count(F.lit(1)).alias("n")).select(text_line(df, sep)) \
        .write.mode("overwrite").text(path)
    return int(obs.get["n"])

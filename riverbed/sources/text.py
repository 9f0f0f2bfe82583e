"""Text files, one row per line (column ``value``), bounded or streaming.

Lines end at ``line_sep``; without one at ``\\n``, ``\\r\\n`` or a lone ``\\r``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _options(**given) -> dict:
    return {k: v for k, v in given.items() if v is not None}


def read_text(spark: SparkSession, path: str, line_sep: str | None = None) -> DataFrame:
    return spark.read.options(**_options(lineSep=line_sep)).text(path)


def stream_text(spark: SparkSession, path: str, files_per_trigger: int | None = None,
                bytes_per_trigger: int | None = None, line_sep: str | None = None) -> DataFrame:
    """New files of a folder as they appear. A micro-batch takes whole files, bounded by number
    or by bytes (the engine takes one of the two; a file above the bytes goes alone)."""
    if files_per_trigger and bytes_per_trigger:
        raise ValueError("bound a micro-batch by files or by bytes")
    return spark.readStream.options(**_options(
        lineSep=line_sep, maxFilesPerTrigger=files_per_trigger or None,
        maxBytesPerTrigger=bytes_per_trigger or None)).text(path)

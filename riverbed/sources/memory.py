"""In-memory rows as a bounded DataFrame, or as a replayable stream.

A stream of literal rows is written once as ordered files in the shared
folder and read back with the file source (``maxFilesPerTrigger`` bounds
each micro-batch), so it can be replayed after a failure, unlike a
memory-only stream.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_path


def rows(spark: SparkSession, data: Iterable[Sequence], schema: str) -> DataFrame:
    """``fromElements`` / ``fromCollection``: literal rows with an explicit schema."""
    return spark.createDataFrame(list(data), schema)


def write_batches(spark: SparkSession, batches: Sequence[Iterable[Sequence]], schema: str,
                  fmt: str = "parquet", name: str = "rows") -> str:
    """Write each batch of rows to its own ordered sub-folder; return the root folder."""
    root = shared_path(spark, name)
    for i, batch in enumerate(batches):
        (spark.createDataFrame(list(batch), schema).coalesce(1)
         .write.mode("overwrite").format(fmt).save(os.path.join(root, f"part-{i:06d}")))
    return root


def stream_of(spark: SparkSession, root: str, schema: str, fmt: str = "parquet",
              files_per_trigger: int = 1) -> DataFrame:
    """Streaming DataFrame over the files under ``root``, oldest first."""
    return (spark.readStream.format(fmt).schema(schema)
            .option("maxFilesPerTrigger", files_per_trigger)
            .option("recursiveFileLookup", "true")
            .load(root))

"""Driver tables: one parquet file (or folder) per table under a scale-factor dir.

Reads are lazy; Catalyst prunes columns and pushes filters into the scan,
so callers should ``select``/``where`` right after ``table(...)``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import shared_path

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

#: files of a micro-batch when a replay asks for a number of micro-batches, about
BATCH_FILES = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table: a parquet file or a folder of part files."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_bytes: int = 128 << 20,
                 order: Sequence[str | Column] = (), close: tuple[str, str] | None = None) -> DataFrame:
    """Replay one driver table as a stream, file by file, ``max_bytes`` a micro-batch.

    ``order`` replays the rows in this order at every size, whatever the order in
    which the table's files were written: no row of a micro-batch precedes a row of
    an earlier one. Without it the files come by modification time.
    ``close``: see :func:`replay`.
    """
    source = table(spark, sf_dir, name)
    if order:
        return replay(source, order, bytes_of(spark, sf_dir, name), max_bytes, close)
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    # the stream source lists folders; the one-character class makes the table's own
    # path a glob, which both a single file and a folder of part files match
    return (spark.readStream.schema(source.schema).option("maxBytesPerTrigger", max_bytes)
            .parquet(path[:-1] + "[t]"))


def bytes_of(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Stored bytes of a driver table."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def replay(source: DataFrame, order: Sequence[str | Column], size: int,
           max_bytes: int = 128 << 20, close: tuple[str, str] | None = None,
           then: DataFrame | None = None, batches: int = 0) -> DataFrame:
    """A stream of the rows of ``source`` in ``order``; ``size``: its bytes, about.

    The rows are first written to the shared folder in ranges of ``order``, one sorted file
    each: one sort and one write of the whole input. The stream source takes files by
    modification time, so the files get times a second apart in the order of their ranges
    (one call a file, so ranges hold ``max_bytes``, the most a micro-batch reads).

    ``batches`` asks for about so many micro-batches even of a small table: a micro-batch takes
    a fixed number of files. How many there are follows from this and from the bytes, never
    from the number of shuffle partitions. ``then`` (with ``batches``): rows that arrive after
    all others. A micro-batch without rows comes before them, because the engine judges late
    rows by the watermark with which the micro-batch before began.

    ``close = (time column, duration)`` ends the stream with one more row, ``duration``
    after the last time, all other columns null and ``_closing`` true: the watermark
    passes the end of every window that real rows are in, so the last windows close and
    their timers fire. ``streaming.operators.open_rows`` drops it again.
    """
    if then is not None and not batches:
        raise ValueError("rows that arrive after all others need micro-batches of their own")
    spark = source.sparkSession
    fs = spark._jvm.org.apache.hadoop.fs
    if close:
        source = source.withColumn("_closing", F.lit(False))
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // max_bytes))
    if batches:
        ranges = max(min(ranges, BATCH_FILES * batches), -(-BATCH_FILES * size // max_bytes))
    folder = fs.Path(shared_path(spark, "replay"))
    conf = spark._jsc.hadoopConfiguration()
    store = folder.getFileSystem(conf)

    def files():
        found = [(s.getPath().getName(), s) for s in store.listStatus(folder)]
        # part-<task>-<job>-c<file of the task>.<codec>.parquet
        parts = [(re.match(r"part-(\d+)-.*-c(\d+)\.", n), s) for n, s in found]
        return [s for _, s in sorted((((int(m[1]), int(m[2])), s) for m, s in parts if m), key=lambda x: x[0])]

    def ordered(df):
        return df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)

    def blanks(n):
        """``n`` files without rows."""
        made = fs.Path(shared_path(spark, "replay-blank"))
        source.limit(0).coalesce(1).write.parquet(made.toString())
        blank = next(s.getPath() for s in store.listStatus(made) if s.getPath().getName().startswith("part-"))
        paths = [fs.Path(folder, f"blank-{i:05d}.parquet") for i in range(n)]
        for p in paths:
            fs.FileUtil.copy(store, blank, store, p, False, conf)
        return paths

    parts = [ordered(source)] + ([ordered(then)] if then is not None else [])
    if close:
        ts, after = close
        ends = source.agg(F.max(ts).alias("last")).where(F.col("last").isNotNull())
        parts.append(ends.select(*(
            (F.col("last") + F.expr(f"INTERVAL {after}")).cast(f.dataType).alias(f.name) if f.name == ts
            else F.lit(True if f.name == "_closing" else None).cast(f.dataType).alias(f.name)
            for f in source.schema.fields)).coalesce(1))
    done, clock, stored, per_batch = [], None, 0, 1
    for i, part in enumerate(parts):
        part.write.mode("append").parquet(folder.toString())
        before = {p.getName() for p in done}
        new = [s for s in files() if s.getPath().getName() not in before]
        if clock is None and new:
            clock = new[-1].getModificationTime() - 1000 * len(new)
        stored += sum(s.getLen() for s in new)
        if batches and i == 0:
            per_batch = max(1, -(-len(new) // max(batches, -(-stored // max_bytes))))
        new = [s.getPath() for s in new]
        if then is not None and i == 0:
            # fill the last micro-batch, and one more
            new += blanks(-len(new) % per_batch + per_batch)
        for p in new:
            clock += 1000
            store.setTimes(p, clock, clock)
        done += new
    times = {s.getPath().getName(): s.getModificationTime() for s in store.listStatus(folder)}
    times = [times[p.getName()] for p in done]
    several = batches or stored > max_bytes
    if several and any(a >= b for a, b in zip(times, times[1:])):
        raise RuntimeError(f"{folder}: this store cannot set file times, so the table cannot be "
                           "replayed in order; name a spark.checkpoint.dir on one that can")
    reader = spark.readStream.schema(source.schema)
    reader = reader.option("maxFilesPerTrigger", per_batch) if batches else reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(folder.toString())


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with ``ts`` as an instant (``TIMESTAMP``) for event-time work.

    The file stores ``TIMESTAMP_NTZ``; ``withWatermark`` rejects that type,
    and with the session zone pinned to UTC the cast keeps the wall clock.
    """
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))

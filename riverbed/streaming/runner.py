"""Run a streaming query over everything available, into files in the shared folder.

* ``append``: Spark's parquet file sink (exactly-once through its metadata log).
* ``complete``: ``foreachBatch`` writes the full result of batch N; only the
  newest two batches are kept.
* ``update``: ``foreachBatch`` writes the changed rows of batch N; the result is
  the newest row per key. Every ``COMPACT_EVERY`` batches the rows are folded
  into one snapshot and the folded batches removed, so neither the log nor a
  reader's work grows with the number of batches.

* ``run_outputs``: several append outputs of one run. Every ``COMPACT_EVERY`` batches
  their folders are folded into one, and as many folded ones into a larger one, so the
  number of folders grows with the logarithm of the number of batches; a folder's name
  tells which batches it holds.

A batch's folder is named by its id and overwritten, so a retried batch is
written once. State, checkpoint and output live in one folder per run under
``spark.checkpoint.dir``. A caller that names its run (``run="orders"``) gets
the same folder every time: a restarted query goes on after its last committed
batch. Without a name each call is a run of its own. Reading the results back
is a distributed job; nothing is collected to the driver.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQueryListener

from ..session import shared_path, stable_path

COMPACT_EVERY = 16
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Stateful processors with several state variables need the RocksDB
    state store; set it (for queries started from now on) if the session
    uses another provider."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, None) != ROCKSDB_PROVIDER:
        spark.conf.set(key, ROCKSDB_PROVIDER)
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled",
                       "true")


def run_folder(spark: SparkSession, name: str, run: str | None) -> str:
    return stable_path(spark, f"stream/{run}") if run else shared_path(spark, name)


class Folder:
    """Sub-folders ``batch=N`` and ``snapshot=N`` of one output."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def ids(self, kind: str) -> list[int]:
        """Finished sub-folders (a write in progress has no success mark yet)."""
        root = self._hadoop.Path(self.path)
        if not self._fs.exists(root):
            return []
        names = [(s.getPath().getName(), s.getPath()) for s in self._fs.listStatus(root)]
        return sorted(int(n.split("=")[1]) for n, p in names if n.startswith(f"{kind}=")
                      and self._fs.exists(self._hadoop.Path(p, "_SUCCESS")))

    def drop(self, kind: str, number: int) -> None:
        self._fs.delete(self._hadoop.Path(f"{self.path}/{kind}={number}"), True)

    def write(self, df: DataFrame, kind: str, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{kind}={number}")

    def read(self, schema: T.StructType, kind: str, number: int) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{kind}={number}") \
            .withColumn("_batch", F.lit(number))

    def spans(self) -> list[tuple[int, int]]:
        """The folders to read, as runs ``(first, last)`` of batch ids: each finished
        ``merged=first-last`` folder that no larger one covers, and the batches beyond."""
        root = self._hadoop.Path(self.path)
        if not self._fs.exists(root):
            return []
        found = []
        for s in self._fs.listStatus(root):
            kind, _, ids = s.getPath().getName().partition("=")
            if kind in ("merged", "batch") and self._fs.exists(self._hadoop.Path(s.getPath(), "_SUCCESS")):
                lo, _, hi = ids.partition("-")
                found.append((int(lo), int(hi or lo)))
        out: list[tuple[int, int]] = []
        for lo, hi in sorted(found, key=lambda x: (x[0], -x[1])):
            if not out or lo > out[-1][1]:
                out.append((lo, hi))
        return out

    def _of(self, span: tuple[int, int]) -> str:
        return f"{self.path}/batch={span[0]}" if span[0] == span[1] else f"{self.path}/merged={span[0]}-{span[1]}"

    def merge(self, schema: T.StructType) -> None:
        """Fold the newest ``COMPACT_EVERY`` folders of one size into one, then these.

        The folded ones go only after the new one is finished; a crash in between leaves
        folders that ``spans`` no longer reads."""
        while True:
            spans = self.spans()
            if not spans:
                return
            width = spans[-1][1] - spans[-1][0] + 1
            same = [x for x in spans if x[1] - x[0] + 1 == width]
            if len(same) < COMPACT_EVERY:
                return
            same = same[:COMPACT_EVERY]
            # no more files than input blocks of 128 MB
            size = sum(self._fs.getContentSummary(self._hadoop.Path(self._of(x))).getLength() for x in same)
            part = self.spark.read.schema(schema).parquet(*map(self._of, same))
            part.coalesce(max(1, -(-size // (128 << 20)))).write.mode("overwrite").parquet(
                self._of((same[0][0], same[-1][1])))
            for x in same:
                self._fs.delete(self._hadoop.Path(self._of(x)), True)

    def read_all(self, schema: T.StructType) -> DataFrame:
        spans = self.spans()
        return (self.spark.read.schema(schema).parquet(*map(self._of, spans)) if spans
                else self.spark.createDataFrame([], schema))

    def log(self, schema: T.StructType) -> DataFrame | None:
        """Newest snapshot and the batches after it."""
        snaps = self.ids("snapshot")[-1:]
        parts = [("snapshot", n) for n in snaps] + [
            ("batch", n) for n in self.ids("batch") if not snaps or n > snaps[0]]
        out = None
        for kind, n in parts:
            part = self.read(schema, kind, n)
            out = part if out is None else out.unionByName(part)
        return out


def _newest(log: DataFrame, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    values = [c for c in schema.names if c not in keys]
    newest = F.max_by(F.struct(*values), F.col("_batch")).alias("_row")
    return log.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_row.{c}") for c in values])


def _compact(folder: Folder, schema: T.StructType, keys: Sequence[str], upto: int) -> None:
    folder.write(_newest(folder.log(schema), schema, keys), "snapshot", upto)
    for n in folder.ids("batch"):
        if n <= upto:
            folder.drop("batch", n)
    for n in folder.ids("snapshot")[:-1]:
        folder.drop("snapshot", n)


def _await(query, timeout_s: int | None, batches: int | None = None) -> None:
    if batches:
        deadline = None if timeout_s is None else time.time() + timeout_s
        while query.isActive and (query.lastProgress is None or query.lastProgress["batchId"] + 1 < batches):
            if deadline and time.time() > deadline:
                break
            time.sleep(0.05)
        query.stop()
    elif timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"stream {query.name} did not finish in {timeout_s}s")
    if query.exception() is not None:
        raise query.exception()


class RunTotals(StreamingQueryListener):
    """Metrics of a run, summed over its micro-batches and restarts.

    Adds up the observed metrics (``df.observe``) of every micro-batch and the rows that
    its stateful operators dropped behind the watermark. The sums are kept in one small
    file beside the run's checkpoint, with the last batch they hold, so a batch that is
    run again after a failure counts once.
    """

    def __init__(self, spark: SparkSession, base: str, query: str):
        self.query, self._hadoop = query, spark._jvm.org.apache.hadoop.fs
        self._path = self._hadoop.Path(f"{base}/totals.json")
        self._fs = self._path.getFileSystem(spark._jsc.hadoopConfiguration())
        self._io = spark._jvm.org.apache.commons.io.IOUtils
        self.spark = spark

    def read(self) -> dict:
        if not self._fs.exists(self._path):
            return {"batch": -1, "rows": 0, "late": 0, "observed": {}}
        stream = self._fs.open(self._path)
        try:
            return json.loads(self._io.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def onQueryProgress(self, event) -> None:
        p, total = event.progress, self.read()
        if p.name != self.query or p.batchId <= total["batch"]:
            return
        total["batch"], total["rows"] = p.batchId, total["rows"] + p.numInputRows
        total["late"] += sum(o.numRowsDroppedByWatermark for o in p.stateOperators)
        for name, row in p.observedMetrics.items():
            for k, v in row.asDict().items():
                key = f"{name}.{k}"
                total["observed"][key] = total["observed"].get(key, 0) + (v or 0)
        part = self._hadoop.Path(f"{self._path}.{uuid.uuid4().hex}")
        out = self._fs.create(part, True)
        out.write(bytearray(json.dumps(total).encode()))
        out.close()
        self._fs.delete(self._path, False)
        self._fs.rename(part, self._path)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def _start(writer, spark: SparkSession, stores: int | None):
    """Start a query whose stateful operators have at most ``stores`` partitions.

    Their number is that of the shuffle partitions when a checkpoint is new; the query takes
    a copy of the session's settings as it starts, so the session's own stays as it was."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    if not stores or stores >= int(before):
        return writer.start()
    spark.conf.set(key, stores)
    try:
        return writer.start()
    finally:
        spark.conf.set(key, before)


def run_counting(df: DataFrame, name: str, run: str | None = None, batches: int | None = None,
                 timeout_s: int | None = None, stores: int | None = None) -> tuple[DataFrame, dict]:
    """``run_available`` in append mode, and the run's totals (:class:`RunTotals`)."""
    spark, query = df.sparkSession, f"{name}-{uuid.uuid4().hex[:8]}"
    totals = RunTotals(spark, run_folder(spark, name, run) if run else shared_path(spark, name), query)
    spark.streams.addListener(totals)
    try:
        out = run_available(df, name, run=run, timeout_s=timeout_s, batches=batches, query=query, stores=stores)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    finally:
        spark.streams.removeListener(totals)
    return out, totals.read()


def run_available(df: DataFrame, name: str, output_mode: str = "append",
                  keys: Sequence[str] | None = None, run: str | None = None,
                  timeout_s: int | None = None, batches: int | None = None,
                  query: str | None = None, stores: int | None = None) -> DataFrame:
    """Process all available input (``availableNow``) and return the result as a batch frame.

    ``run`` names a run that later calls resume; ``timeout_s`` stops a query
    that takes longer (default: none). ``batches`` stops the run once so many
    micro-batches are committed (one more may have begun; a later call of the same run
    does it again, and what it wrote counts once). ``query`` names the query. ``stores``: at
    most so many state stores an operator (default: the shuffle partitions); each is opened
    and committed in every micro-batch, rows or not. A resumed run keeps its number.
    """
    spark, schema = df.sparkSession, df.schema
    if output_mode not in ("append", "complete", "update"):
        raise ValueError(output_mode)
    if output_mode == "update" and not keys:
        raise ValueError("update mode needs the result keys")
    use_rocksdb_state(spark)
    base = run_folder(spark, name, run)
    writer = df.writeStream.option("checkpointLocation", f"{base}/checkpoint")
    writer = writer.trigger(processingTime="0 seconds") if batches else writer.trigger(availableNow=True)
    if query:
        writer = writer.queryName(query)
    if output_mode == "append":
        _await(_start(writer.format("parquet").option("path", f"{base}/out").outputMode("append"), spark, stores),
               timeout_s, batches)
        return spark.read.schema(schema).parquet(f"{base}/out")

    folder = Folder(spark, f"{base}/out")

    def write_batch(batch: DataFrame, number: int) -> None:
        folder.write(batch, "batch", number)
        if output_mode == "complete":
            for n in folder.ids("batch")[:-2]:
                folder.drop("batch", n)
        elif number % COMPACT_EVERY == COMPACT_EVERY - 1:
            _compact(folder, schema, keys, number)

    _await(_start(writer.outputMode(output_mode).foreachBatch(write_batch), spark, stores), timeout_s, batches)
    if output_mode == "complete":
        batches = folder.ids("batch")
        return (folder.read(schema, "batch", batches[-1]) if batches
                else spark.createDataFrame([], schema).withColumn("_batch", F.lit(0))) \
            .select(*schema.names)
    log = folder.log(schema)
    return spark.createDataFrame([], schema) if log is None else _newest(log, schema, keys)


def run_outputs(df: DataFrame, name: str, outputs: Mapping[str, Callable[[DataFrame], DataFrame]],
                run: str | None = None, timeout_s: int | None = None) -> dict[str, DataFrame]:
    """One run, several outputs: each micro-batch is computed once and every output's
    function is applied to it. Returns a batch frame per output, all batches together."""
    spark = df.sparkSession
    use_rocksdb_state(spark)
    base = run_folder(spark, name, run)
    folders = {k: Folder(spark, f"{base}/out-{k}") for k in outputs}
    empty = spark.createDataFrame([], df.schema)
    schemas = {k: f(empty).schema for k, f in outputs.items()}

    def write_batch(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            for k, f in outputs.items():
                if not any(lo <= number <= hi and lo < hi for lo, hi in folders[k].spans()):
                    folders[k].write(f(batch), "batch", number)
                    folders[k].merge(schemas[k])
        finally:
            batch.unpersist()

    _await(df.writeStream.option("checkpointLocation", f"{base}/checkpoint")
           .trigger(availableNow=True).foreachBatch(write_batch).start(), timeout_s)
    return {k: folders[k].read_all(schemas[k]) for k in outputs}

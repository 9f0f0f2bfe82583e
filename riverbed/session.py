"""Session construction and the shared working folder.

Everything the library writes (stream checkpoints, sink output, lineage
cuts) goes under the folder the cluster names in ``spark.checkpoint.dir``.
We only invent one when that setting is missing and the master is ``local``
(tests and the bench); on a cluster a missing setting is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every session built here gets. AQE re-plans joins and shuffle
# sizes at runtime and splits skewed join partitions; the state store is
# RocksDB because the stateful processors need list and map state.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # parsers rely on ANSI casts and array access to fail on malformed input
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # remove reliable-checkpoint files once their RDD is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "riverbed", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's defaults.

    On a cluster ``master`` and ``shuffle_partitions`` stay ``None`` so that
    spark-submit and the cluster's own settings decide.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        # local tests and benches: driver and executors are one machine
        current = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def stable_path(spark: SparkSession, name: str) -> str:
    """A fixed sub-folder of the shared folder, for outputs written in
    overwrite mode (re-running replaces them instead of adding more)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return os.path.join(base, "riverbed", name)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for ``name``."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``riverbed`` importable in Python workers (pandas UDFs, stateful
    processors, ``foreachBatch`` runners) wherever the driver was started.

    The package is zipped on the driver and registered with ``addPyFile``;
    Spark then distributes it to every executor. Once per SparkContext.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    # driver-side build artefact only; Spark ships it to the executors
    target = os.path.join(tempfile.mkdtemp(prefix="riverbed-pkg-"), "riverbed.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, dirs, files in os.walk(pkg):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)
    # Driver-side Python runners (stateful-processor schema checks,
    # foreachBatch) do not read addPyFile files; they take PYTHONPATH from
    # the environment PySpark sends with every Python function.
    paths = [p for p in sc.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    sc.environment["PYTHONPATH"] = os.pathsep.join(paths + [target])
    _SHIPPED.add(sc.applicationId)

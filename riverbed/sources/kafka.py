"""Kafka topic of strings with a consumer group.

Needs the ``spark-sql-kafka`` package on the classpath (not bundled here).
Each topic partition becomes one task per micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def kafka_options(topic: str, bootstrap_servers: str, group_id: str | None = None,
                  starting_offsets: str = "latest", **extra: str) -> dict[str, str]:
    opts = {"subscribe": topic, "kafka.bootstrap.servers": bootstrap_servers,
            "startingOffsets": starting_offsets}
    if group_id:
        opts["kafka.group.id"] = group_id
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def stream_kafka_strings(spark: SparkSession, topic: str, bootstrap_servers: str,
                         group_id: str | None = None, **extra: str) -> DataFrame:
    """Streaming DataFrame with one ``value string`` column (the message text)."""
    raw = (spark.readStream.format("kafka")
           .options(**kafka_options(topic, bootstrap_servers, group_id, **extra)).load())
    return raw.select(F.col("value").cast("string").alias("value"))

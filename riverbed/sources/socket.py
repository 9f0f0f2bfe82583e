"""Text socket stream (one row per line). Spark's socket source keeps no
replay log, so it is for demos only; production streams use Kafka or files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def socket_options(host: str = "localhost", port: int | str = 9999) -> dict[str, str]:
    """Validated options for ``readStream.format("socket")``; the port must be an integer."""
    port = int(port)
    if not 0 < port < 65536:
        raise ValueError(f"port out of range: {port}")
    return {"host": str(host), "port": str(port)}


def stream_socket(spark: SparkSession, host: str = "localhost", port: int | str = 9999
                  ) -> DataFrame:
    return spark.readStream.format("socket").options(**socket_options(host, port)).load()

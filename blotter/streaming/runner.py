"""Run a streaming query over everything available, with a durable checkpoint
below the shared checkpoint folder (R1); re-running with the same checkpoint
resumes where the last run stopped (R2)."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


@contextmanager
def state_partitions(spark: SparkSession, per_core: int = 1):
    """Size the state partitions of queries started inside the block to at
    most ``per_core`` x the cluster's cores.  A stateful query keeps its
    partition count for the life of its checkpoint, and every micro-batch
    opens one state store per partition, so more state partitions than
    cores only add per-batch overhead.  The session setting is restored."""
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # remote (Connect) session: leave the setting alone
        cores = None
    if cores:
        spark.conf.set(key, str(min(int(old), per_core * cores)))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def run_available_now(df: DataFrame, checkpoint: str, path: str | None = None,
                      fmt: str = "parquet", output_mode: str = "append",
                      foreach_batch: Callable | None = None, timeout_s: float | None = None):
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(fmt).option("path", path)
    q = w.trigger(availableNow=True).start()
    q.awaitTermination(timeout_s)
    if q.exception() is not None:
        raise q.exception()
    return q

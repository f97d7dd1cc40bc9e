"""Session helpers: UTC event time and a shared checkpoint location."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "blotter", extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and local runs.  On a cluster use the cluster's
    session and call :func:`ensure_utc` on it."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


PARTITION_BYTES = 256 * 1024 * 1024


def partitions_for(input_bytes: int, partition_bytes: int = PARTITION_BYTES) -> int:
    """Partitions of about ``partition_bytes`` each; no upper limit."""
    return max(1, -(-int(input_bytes) // partition_bytes))


#: Rows that a task sorts: Spark's rows take some hundred bytes each, so a sort stays at a few hundred MB
#: whatever they take in a file.
PARTITION_ROWS = 500_000


def partitions_for_rows(rows: int, partition_rows: int = PARTITION_ROWS) -> int:
    """Partitions of about ``partition_rows`` rows each; no upper limit."""
    return max(1, -(-int(rows) // partition_rows))


@contextmanager
def shuffles_for_rows(spark: SparkSession, rows: int):
    """Shuffles planned inside the block have at least the partitions that ``rows`` ask
    for.  The session setting is restored."""
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, str(max(int(old), partitions_for_rows(rows))))
        yield
    finally:
        spark.conf.set(key, old)


def plan_bytes(df) -> int | None:
    """Catalyst's estimate of a plan's output size, or None where it knows none."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 58 else None


def scale_settings(input_bytes: int, partition_bytes: int = PARTITION_BYTES) -> dict[str, str]:
    """Shuffle and scan sizing for a given input volume.

    Scan splits and shuffle partitions both target ``partition_bytes`` (so a
    task's data fits executor memory with room for sort/aggregation buffers);
    AQE then coalesces small shuffle partitions and splits skewed join
    partitions at run time.  Example: 100 TB -> 409,600 partitions.
    """
    n = partitions_for(input_bytes, partition_bytes)
    size = f"{partition_bytes // (1024 * 1024)}m"
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def apply_scale_settings(spark: SparkSession, input_bytes: int, **kw) -> dict[str, str]:
    conf = scale_settings(input_bytes, **kw)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure_streaming_state(spark: SparkSession) -> None:
    """State of the job's stateful operators in RocksDB (off-heap, sized by
    open windows, not by executor heap) with changelog checkpointing
    (incremental uploads), unless the session already chose a provider.
    Applies to queries started afterwards; a checkpoint keeps its provider."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, "").endswith("HDFSBackedStateStoreProvider") or not spark.conf.get(key, ""):
        spark.conf.set(key, ROCKSDB_PROVIDER)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def ensure_utc(spark: SparkSession) -> SparkSession:
    """Incident dates are local date-times read as UTC; pin the session zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    When the session names none, a private temporary folder is used only for
    a local master (tests, local runs); on a cluster that would be a
    machine-local path, so it is an error instead.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # remote (Connect) session: the server owns checkpoints
        sc = None
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster "
                             "(streaming checkpoints and lineage cuts are written there)")
        d = tempfile.mkdtemp(prefix="blotter-chk-")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/blotter/{name}-{uuid.uuid4().hex[:12]}"


"""The streaming job (Q1/Q2 + Q3 over Q4), configured by ``PipelineConfig``.

One streaming query: its source is read, parsed and enriched once per micro-batch,
and ``foreachBatch`` feeds the monthly image (upserted into the serving table), the
alert lines and the rejected records (:class:`~blotter.streaming.fanout.JobBatch`).  State,
watermark and marks lie below ``<checkpoint>/job``.  The code table is snapshotted
once per start, so every micro-batch joins the same rows however large it is.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from blotter.config import PipelineConfig
from blotter.functions.parse import classified_records
from blotter.session import checkpoint_root, ensure_utc
from blotter.sinks.alerts import write_alert_log
from blotter.sinks.serving import create_serving_table, serving_batch_writer
from blotter.sources.codes import load_code_table, snapshot_code_table
from blotter.sources.records import incident_records
from blotter.streaming.fanout import JobBatch, Join
from blotter.streaming.statelog import Ledger, last_mark


@dataclass
class Outputs:
    serving_path: str
    alert_path: str | None = None       # text folder twin of the alert topic
    alert_kafka: dict | None = None     # Kafka sink options (kafka_sink_options)
    rejects_path: str | None = None


def record_stream(spark: SparkSession, cfg: PipelineConfig, checkpoint: str) -> tuple[DataFrame, Join]:
    """Typed records of the source, and the join that enriches a micro-batch of them."""
    ensure_utc(spark)
    codes = snapshot_code_table(spark, load_code_table(spark, cfg.lookup_path, cfg.lookup_parse),
                                f"{checkpoint}/code-table/{uuid.uuid4().hex[:12]}")     # loaded once, at every size
    source = dict(cfg.source)
    if source.get("kind", "directory") == "directory":
        source.setdefault("staged", f"{checkpoint}/replay")
    records = incident_records(spark, source, streaming=True)
    keep = ("arrival",) if "arrival" in records.columns else ()
    rows = classified_records(records, cfg.on_error, keep_columns=keep)
    if keep:
        rows = rows.withColumn("source_partition", F.col("arrival.partition"))
    return rows, Join(codes, cfg.broadcast_max_rows, cfg.broadcast_max_bytes, cfg.salt_buckets)


def job_batch(spark: SparkSession, cfg: PipelineConfig, out: Outputs, checkpoint: str, join: Join, columns: list[str]) -> JobBatch:
    """The outputs of the job over one micro-batch."""
    create_serving_table(spark, out.serving_path, cfg.keep_year)
    upsert = serving_batch_writer(out.serving_path, "_order", cfg.keep_year, staging=f"{checkpoint}/job/upsert")
    run = Ledger(f"{checkpoint}/job", 0).run_id(spark)

    def serving(rows: DataFrame, epoch: int) -> None:
        upsert(rows.withColumn("year", F.year("month_start")) if cfg.keep_year else rows, epoch)

    def alert_lines(rows: DataFrame, epoch: int) -> None:
        if out.alert_kafka and not out.alert_path:
            write_alert_log(rows, kafka_options=out.alert_kafka)      # at least once, as the reference's sink
        else:
            write_alert_log(rows, f"{out.alert_path}/run={run}/batch={epoch}", mode="overwrite")

    def rejects(rows: DataFrame, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out.rejects_path}/run={run}/batch={epoch}")

    by_partition = "source_partition" in columns
    return JobBatch(
        f"{checkpoint}/job", join, cfg.watermark_seconds, serving, alert_lines if out.alert_path or out.alert_kafka else None,
        rejects if out.rejects_path else None, cfg.emit_every_row, cfg.anomaly_period_days, cfg.anomaly_slide_days,
        cfg.anomaly_threshold, "arrival" if "arrival" in columns else None, "source_partition" if by_partition else None,
        cfg.source_partitions)


def start_job(spark: SparkSession, cfg: PipelineConfig, out: Outputs,
              trigger: dict | None = None) -> list[StreamingQuery]:
    """Start the job; ``trigger`` e.g. {"processingTime": "30 seconds"} (the
    reference checkpoints every 30 s) or {"availableNow": True}."""
    trigger = trigger or {"processingTime": "30 seconds"}
    chk = job_checkpoint(spark, cfg)
    records, join = record_stream(spark, cfg, chk)
    batch = job_batch(spark, cfg, out, chk, join, records.columns)
    return [records.writeStream.foreachBatch(batch).option("checkpointLocation", f"{chk}/job/query").trigger(**trigger).start()]


def job_checkpoint(spark: SparkSession, cfg: PipelineConfig) -> str:
    return (cfg.checkpoint_dir or f"{checkpoint_root(spark)}/blotter-job").rstrip("/")


def job_late_rows(spark: SparkSession, cfg: PipelineConfig) -> tuple[int, int]:
    """L1: rows dropped because their month had closed, and (row, sliding window) pairs
    dropped because the window had, over all runs of the job on its checkpoint."""
    mark = last_mark(spark, f"{job_checkpoint(spark, cfg)}/job")
    return mark.late_rows, mark.late_windows


def stop_all(queries: list[StreamingQuery]) -> None:
    for q in queries:
        q.stop()


def run_to_end(queries: list[StreamingQuery], poll_seconds: float = 0.5) -> None:
    """Wait for all queries; the first failure stops the others and is raised,
    so the job fails as a whole."""
    while True:
        for q in queries:
            if q.exception() is not None:
                error = q.exception()
                stop_all(queries)
                raise error
        running = [q for q in queries if q.isActive]
        if not running:
            failed = [q.exception() for q in queries if q.exception() is not None]
            if failed:
                raise failed[0]
            return
        running[0].awaitTermination(poll_seconds) if len(running) == 1 else time.sleep(poll_seconds)


def run_with_restarts(start: Callable[[], list[StreamingQuery]], restarts: int = 3, delay_seconds: float = 10.0,
                      sleep: Callable[[float], None] = time.sleep) -> int:
    """Run what ``start`` starts to its end; after a failure wait and start again, on the same
    checkpoint, up to ``restarts`` times (the reference's fixed-delay strategy).  Returns the restarts used."""
    for used in range(restarts + 1):
        try:
            run_to_end(start())
            return used
        except Exception:
            if used == restarts:
                raise
            sleep(delay_seconds)
    return restarts

"""Streaming pipelines over the given tables (file streams, availableNow).

Outputs go below the shared checkpoint folder; each callable returns a batch
DataFrame over the committed output.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.config import PipelineConfig
from blotter.files import data_files, set_times
from blotter.functions.parse import parse_records, with_event_time
from blotter.operators.anomaly import alert_messages, alerts, anomaly_results
from blotter.operators.enrich import enrich
from blotter.plans.queries import plain_timestamps
from blotter.plans.standins import (as_csv_records, lineitem_as_incidents, lineitem_csv_records, orders_as_incidents,
                                    part_code_lines, part_codes, table, table_stream)
from blotter.schema import COUNTERS
from blotter.session import ensure_utc, scratch_path
from blotter.sinks.alerts import write_alert_log
from blotter.sinks.serving import serving_batch_writer, truncate_serving_table
from blotter.sources.codes import snapshot_code_table
from blotter.sources.read_models import read_alert_log, read_serving
from blotter.sources.records import directory_lines, keyed_lines, replay_in_path_order, write_line_files
from blotter.streaming.panes import SlidingImage
from blotter.streaming.runner import run_available_now, state_partitions
from blotter.streaming.stateful import PerRowImage, parquet_sink
from blotter.streaming.windows import month_image_stream, sliding_counts_stream, with_watermark

CFG = PipelineConfig()
IMAGE_COLS = ["district", "month", "primary_description", *COUNTERS, "month_start"]


def _orders_events(stream: DataFrame) -> DataFrame:
    return with_watermark(with_event_time(orders_as_incidents(stream)), "ts", CFG.watermark)


def q_stream_month_image_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    img = month_image_stream(_orders_events(table_stream(spark, sf_dir, "orders")))
    out = scratch_path(spark, "stream-month-c")
    with state_partitions(spark):
        run_available_now(img, out + "-chk", out)
    return plain_timestamps(spark.read.schema(img.schema).parquet(out).select(*IMAGE_COLS))


def q_stream_sliding_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    ev = with_watermark(table_stream(spark, sf_dir, "events"), "ts", CFG.watermark)
    win = sliding_counts_stream(
        ev, 7, 1, key="event_type",
        aggs=[F.count(F.lit(1)).alias("count"),
              F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("total_cents"),
              F.max("value").alias("max_value")])
    out = scratch_path(spark, "stream-sliding-events")
    with state_partitions(spark):
        run_available_now(win, out + "-chk", out)
    return plain_timestamps(spark.read.schema(win.schema).parquet(out))


def q_stream_month_image_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    events = with_event_time(orders_as_incidents(table_stream(spark, sf_dir, "orders")))
    out = scratch_path(spark, "stream-month-a")
    run_available_now(events, out + "-chk", foreach_batch=PerRowImage(
        out + "-chk/per-row", parquet_sink(out), CFG.watermark_seconds))
    return plain_timestamps(spark.read.parquet(out).select(
        "id", "district", "month", "primary_description", "month_start", *COUNTERS))


def q_stream_running_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 + R2: mode A stopped halfway and resumed on its checkpoint with another
    number of shuffle partitions; the counters go on where they stopped."""
    ensure_utc(spark)
    orders = table(spark, sf_dir, "orders")
    staging, out = scratch_path(spark, "resume-input"), scratch_path(spark, "stream-resume")
    key = "spark.sql.shuffle.partitions"
    old = int(spark.conf.get(key))
    cut = F.lit("1998-07-01").cast("timestamp_ntz")
    try:
        for step, rows in enumerate((orders.where(F.col("o_orderdate") < cut), orders.where(F.col("o_orderdate") >= cut))):
            rows.write.parquet(f"{staging}/arrival-{step}")
            spark.conf.set(key, str(old + 3 * step))
            source = spark.readStream.schema(orders.schema).option("recursiveFileLookup", "true").parquet(staging)
            run_available_now(with_event_time(orders_as_incidents(source)), out + "-chk", foreach_batch=PerRowImage(
                out + "-chk/per-row", parquet_sink(out), CFG.watermark_seconds))
    finally:
        spark.conf.set(key, str(old))
    return plain_timestamps(spark.read.parquet(out).select(
        "id", "district", "month", "primary_description", "month_start", *COUNTERS))


def q_stream_anomaly_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 end to end: published CSV lines -> directory stream -> parse ->
    broadcast enrichment -> sliding windows from panes -> alerts -> text log."""
    ensure_utc(spark)
    staged = scratch_path(spark, "incident-lines")
    write_line_files(lineitem_csv_records(spark, sf_dir, varied=False), staged)
    codes = part_codes(spark, sf_dir)
    incidents, _ = parse_records(keyed_lines(directory_lines(spark, staged, streaming=True,
                                                             files_per_trigger=None)))
    log = scratch_path(spark, "alert-log")

    def sink(windows: DataFrame, epoch: int) -> None:
        lines = alert_messages(alerts(anomaly_results(windows), CFG.anomaly_threshold))
        write_alert_log(lines, f"{log}/batch={epoch}", mode="overwrite")

    run_available_now(enrich(with_event_time(incidents), codes), log + "-chk", foreach_batch=SlidingImage(
        log + "-chk/windows", sink, CFG.watermark_seconds, CFG.anomaly_period_days, CFG.anomaly_slide_days))
    return read_alert_log(spark, log)


def q_stream_serving_image_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 end to end: mode C month windows upserted into the serving table."""
    ensure_utc(spark)
    codes = part_codes(spark, sf_dir)
    events = with_watermark(with_event_time(lineitem_as_incidents(table_stream(spark, sf_dir, "lineitem"))),
                            "ts", CFG.watermark)
    img = month_image_stream(enrich(events, codes))
    table_path = scratch_path(spark, "serving")
    with state_partitions(spark):
        run_available_now(img, table_path + "-chk", foreach_batch=serving_batch_writer(
            table_path, "month_end", staging=table_path + "-chk/upsert"))
    return read_serving(spark, table_path)


def q_stream_serving_image_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 end to end: one emission per incident upserted into the serving
    table; the final table holds each key's newest month in full."""
    ensure_utc(spark)
    codes = part_codes(spark, sf_dir)
    events = enrich(with_event_time(lineitem_as_incidents(table_stream(spark, sf_dir, "lineitem"))), codes)
    table_path = scratch_path(spark, "serving")
    chk = table_path + "-chk"
    upsert = serving_batch_writer(table_path, "_order", staging=f"{chk}/upsert")
    run_available_now(events, chk, foreach_batch=PerRowImage(
        f"{chk}/per-row", lambda rows, epoch: upsert(rows.withColumn("_order", F.struct("month_start", "count")), epoch),
        CFG.watermark_seconds))
    return read_serving(spark, table_path)


def q_serving_rerun_fresh_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + K4: a job fills the table from the odd orders, the table is truncated, and another
    job with a fresh checkpoint fills it anew from all orders: nothing of the first run may
    come back."""
    ensure_utc(spark)
    codes = part_codes(spark, sf_dir)
    li = table(spark, sf_dir, "lineitem")
    staging, table_path = scratch_path(spark, "rerun-input"), scratch_path(spark, "rerun-serving")
    for run, rows in enumerate((li.where(F.col("l_orderkey") % 2 == 1), li)):
        rows.write.parquet(f"{staging}/{run}")
        stream = spark.readStream.schema(li.schema).parquet(f"{staging}/{run}")
        img = month_image_stream(enrich(with_watermark(with_event_time(lineitem_as_incidents(stream)), "ts", CFG.watermark), codes))
        chk = f"{table_path}-chk{run}"
        with state_partitions(spark):
            run_available_now(img, chk, foreach_batch=serving_batch_writer(table_path, "month_end", staging=f"{chk}/upsert"))
        if run == 0:
            truncate_serving_table(spark, table_path)
    return read_serving(spark, table_path)


def _run_job(spark: SparkSession, sf_dir: str, mode: str = "C"):
    """The streaming job itself (``start_job``) over published incident lines and
    a code-table file derived from the tables, all outputs running."""
    from blotter.plans.job import Outputs, run_to_end, start_job
    ensure_utc(spark)
    lines_dir, codes_dir = scratch_path(spark, "job-lines"), scratch_path(spark, "job-codes")
    write_line_files(lineitem_csv_records(spark, sf_dir, varied=False), lines_dir)
    part_code_lines(spark, sf_dir).write.text(codes_dir)
    cfg = CFG.with_(mode=mode, lookup_path=codes_dir, checkpoint_dir=scratch_path(spark, "job-chk"),
                    source={"kind": "directory", "path": lines_dir, "files_per_trigger": None})
    out = Outputs(serving_path=scratch_path(spark, "job-serving"), alert_path=scratch_path(spark, "job-alerts"))
    with state_partitions(spark):
        run_to_end(start_job(spark, cfg, out, {"availableNow": True}))
    return out


def q_job_stream_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job's serving table, mode C."""
    return read_serving(spark, _run_job(spark, sf_dir).serving_path)


def q_job_stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job's alert log."""
    return read_alert_log(spark, _run_job(spark, sf_dir).alert_path)


def q_job_mode_a_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job's serving table when the mode option says A."""
    return read_serving(spark, _run_job(spark, sf_dir, "A").serving_path)


#: Lines of a replayed file, about 128 MB.
FILE_LINES = 2_000_000


def replay_files(lines: int, codes: int) -> int:
    """Files to replay ``lines`` from, each a micro-batch.  A micro-batch reads and sorts the code
    table for its join, so a file has at least as many lines as that has rows: all micro-batches
    together then read no more of it than there are lines."""
    return max(8, lines // max(FILE_LINES, codes))


def q_replay_path_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line files whose path order is the order of their dates, but whose modification times
    run backwards, are replayed in path order, one per micro-batch, so that the month
    windows close in turn and no row is late.  A large file is replayed as several parts: lines are
    in the order of their dates within a file too, and a micro-batch takes as many parts
    as a file has on average."""
    ensure_utc(spark)
    codes = snapshot_code_table(spark, part_codes(spark, sf_dir), scratch_path(spark, "replay-codes"))
    li = table(spark, sf_dir, "lineitem")
    source, staged = scratch_path(spark, "replay-source"), scratch_path(spark, "replay-staged")
    parts = replay_files(li.count(), codes.rows)
    write_line_files(as_csv_records(li.repartitionByRange(parts, "l_shipdate").sortWithinPartitions("l_shipdate"), varied=False), source)
    found = data_files(spark, source)
    set_times(spark, found[::-1], int(time.time() * 1000) - len(found))
    replayed = replay_in_path_order(spark, source, staged)
    at_once = max(1, -(-len(data_files(spark, f"{staged}/files")) // max(1, len(found))))
    incidents, _ = parse_records(keyed_lines(directory_lines(spark, replayed, streaming=True, files_per_trigger=at_once)))
    img = month_image_stream(enrich(with_watermark(with_event_time(incidents), "ts", CFG.watermark), codes))
    out = scratch_path(spark, "replay-image")
    with state_partitions(spark):
        run_available_now(img, out + "-chk", out)
    return plain_timestamps(spark.read.schema(img.schema).parquet(out).select(*IMAGE_COLS))


# three arrivals derived from orders: the June 1999 rows come after the
# watermark passed their month (dropped); early-June 2001 rows come after
# the watermark passed their own time but not their month end (counted).
def _late_row_stages():
    d = F.col("o_orderdate")
    held_closed = (d >= F.lit("1999-06-01").cast("timestamp_ntz")) & (d < F.lit("1999-07-01").cast("timestamp_ntz"))
    held_open = (d >= F.lit("2001-06-01").cast("timestamp_ntz")) & (d < F.lit("2001-06-08").cast("timestamp_ntz"))
    y2000 = F.lit("2000-01-01").cast("timestamp_ntz")
    cut = F.lit("2001-06-10").cast("timestamp_ntz")
    return [
        (d < y2000) & ~held_closed,
        (d >= y2000) & (d < cut) & ~held_open,
        held_closed | held_open | (d >= cut),
    ]


def q_stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 + R2: three runs of one query on one checkpoint, one arrival each."""
    ensure_utc(spark)
    orders = table(spark, sf_dir, "orders")
    staging = scratch_path(spark, "late-stages")
    out = scratch_path(spark, "stream-late")
    img = None
    for i, pred in enumerate(_late_row_stages(), start=1):
        orders.where(pred).write.parquet(f"{staging}/arrival-{i}")
        if img is None:
            src = (spark.readStream.schema(orders.schema).option("recursiveFileLookup", "true")
                   .parquet(staging))
            img = month_image_stream(_orders_events(src))
        with state_partitions(spark):
            run_available_now(img, out + "-chk", out)
    return plain_timestamps(spark.read.schema(img.schema).parquet(out).select(*IMAGE_COLS))

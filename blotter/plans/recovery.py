"""Streaming pipelines over the given tables that show state, recovery and lateness:
delta logs with compaction, resuming with another number of partitions, source
partitions that lag, rows late for some windows only, and a hot code in the join.

Each callable writes its arrivals below the shared checkpoint folder, runs one query over
them on one checkpoint, and returns a batch DataFrame over the committed output.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.config import PipelineConfig
from blotter.functions.parse import with_event_time
from blotter.plans.queries import plain_timestamps
from blotter.plans.standins import lineitem_as_incidents, orders_as_incidents, part_codes, table
from blotter.schema import COUNTERS
from blotter.session import ensure_utc, scratch_path
from blotter.sinks.alerts import write_alert_log
from blotter.sinks.serving import serving_batch_writer
from blotter.sources.read_models import read_alert_log, read_serving
from blotter.streaming.fanout import JobBatch, Join
from blotter.streaming.runner import run_available_now
from blotter.streaming.statelog import last_mark
from blotter.streaming.stateful import MonthImage, PerRowImage, parquet_sink

CFG = PipelineConfig()
IMAGE_COLS = ["district", "month", "primary_description", *COUNTERS, "month_start"]


def in_arrivals(spark: SparkSession, rows: DataFrame, steps: Sequence[Column], shape: Callable[[DataFrame], DataFrame],
                chk: str, batch: Callable, partitions: Sequence[int] = ()) -> None:
    """One query over ``rows`` in several arrivals: the rows of each step are added to its
    input folder and it is started anew on its checkpoint, with the step's number of
    shuffle partitions where ``partitions`` has one."""
    staging, key = scratch_path(spark, "arrivals"), "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    try:
        for i, step in enumerate(steps):
            rows.where(step).write.parquet(f"{staging}/arrival-{i}")
            if partitions:
                spark.conf.set(key, str(partitions[i]))
            source = spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").parquet(staging)
            run_available_now(shape(source), chk, foreach_batch=batch)
    finally:
        spark.conf.set(key, old)


def _between(column: str, start: str | None, end: str | None) -> Column:
    d = F.col(column)
    cond = F.lit(True) if start is None else d >= F.lit(start).cast("timestamp_ntz")
    return cond if end is None else cond & (d < F.lit(end).cast("timestamp_ntz"))


def late_steps(column: str) -> list[Column]:
    """Three arrivals: June 1999 comes after its month has closed, the first week of June
    2001 when its month and some of its sliding windows are still open."""
    june_1999, week_2001 = _between(column, "1999-06-01", "1999-07-01"), _between(column, "2001-06-01", "2001-06-08")
    first = _between(column, None, "2000-01-01") & ~june_1999
    second = _between(column, "2000-01-01", "2001-06-10") & ~week_2001
    return [first, second, ~first & ~second]


def _order_events(stream: DataFrame) -> DataFrame:
    return with_event_time(orders_as_incidents(stream))


def q_stream_state_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 + R1: mode A over a year's orders at a time, the state compacted every second micro-batch."""
    ensure_utc(spark)
    out = scratch_path(spark, "state-log")
    bounds = [None, *(f"{y}-01-01" for y in range(1996, 2002)), None]
    steps = [_between("o_orderdate", a, b) for a, b in zip(bounds, bounds[1:])]
    in_arrivals(spark, table(spark, sf_dir, "orders"), steps, _order_events, out + "-chk",
                PerRowImage(out + "-chk/per-row", parquet_sink(out), CFG.watermark_seconds, compact_every=2))
    return plain_timestamps(spark.read.parquet(out).select("id", "district", "month", "primary_description", "month_start", *COUNTERS))


def q_stream_late_rows_resized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: mode C stopped with 4 partitions, resumed with 7, then with 5; late rows as in ``stream_late_rows``."""
    ensure_utc(spark)
    out = scratch_path(spark, "resized")
    in_arrivals(spark, table(spark, sf_dir, "orders"), late_steps("o_orderdate"), _order_events, out + "-chk",
                MonthImage(out + "-chk/months", parquet_sink(out), CFG.watermark_seconds), partitions=(4, 7, 5))
    return plain_timestamps(spark.read.parquet(out).select(*IMAGE_COLS))


def q_stream_lagging_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two source partitions, one of which is two years behind in the first arrival.  The
    watermark is the lesser of the two, so its rows are not late when they come."""
    ensure_utc(spark)
    behind = F.col("o_custkey") % 2 == 1
    first = F.when(behind, _between("o_orderdate", None, "1998-01-01")).otherwise(_between("o_orderdate", None, "2000-01-01"))
    out = scratch_path(spark, "lagging")

    def events(stream: DataFrame) -> DataFrame:
        return with_event_time(orders_as_incidents(stream, (F.col("o_custkey") % 2).cast("int").alias("source_partition")))

    in_arrivals(spark, table(spark, sf_dir, "orders"), [first, ~first], events, out + "-chk",
                MonthImage(out + "-chk/months", parquet_sink(out), CFG.watermark_seconds, partition_col="source_partition", partitions=2))
    return plain_timestamps(spark.read.parquet(out).select(*IMAGE_COLS))


def classified(incidents: DataFrame) -> DataFrame:
    """Typed incidents in the shape of ``classified_records``, none rejected."""
    return incidents.select("*", *[F.lit(None).cast("string").alias(c) for c in ("reason", "key", "value")])


def _late_job(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The job's fan-out over the late arrivals of lineitem; (alert log, checkpoint)."""
    ensure_utc(spark)
    out = scratch_path(spark, "late-job")
    batch = JobBatch(f"{out}/chk/job", Join(part_codes(spark, sf_dir), CFG.broadcast_max_rows, CFG.broadcast_max_bytes), CFG.watermark_seconds,
                     serving_batch_writer(f"{out}/serving", "_order", staging=f"{out}/chk/upsert"),
                     lambda rows, epoch: write_alert_log(rows, f"{out}/alerts/batch={epoch}", mode="overwrite"), threshold=50.0)
    in_arrivals(spark, table(spark, sf_dir, "lineitem"), late_steps("l_shipdate"),
                lambda s: classified(lineitem_as_incidents(s)), f"{out}/chk/query", batch)
    return f"{out}/alerts", f"{out}/chk/job"


def q_stream_late_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 + T1 + L1: alerts above 50 % when rows come late: each counts in those of its
    windows that are still open."""
    return read_alert_log(spark, _late_job(spark, sf_dir)[0])


def q_stream_late_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: rows dropped from closed months, and (row, window) pairs dropped from closed windows."""
    mark = last_mark(spark, _late_job(spark, sf_dir)[1])
    return spark.createDataFrame([(mark.late_rows, mark.late_windows)], "late_rows long, late_windows long")


def q_stream_hot_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + Q4: a third of the incidents have one code, and the code table is over its bound of
    broadcasting: the shuffle join salts the codes that the sketch finds hot."""
    ensure_utc(spark)
    out = scratch_path(spark, "hot-code")
    batch = JobBatch(f"{out}/chk/job", Join(part_codes(spark, sf_dir), 0, 0), CFG.watermark_seconds,
                     serving_batch_writer(f"{out}/serving", "_order", staging=f"{out}/chk/upsert"))
    hot = F.when(F.col("id") % 30 < 10, F.lit("1")).otherwise(F.col("iucr_code"))
    in_arrivals(spark, table(spark, sf_dir, "lineitem"), [F.lit(True)],
                lambda s: classified(lineitem_as_incidents(s).withColumn("iucr_code", hot)), f"{out}/chk/query", batch)
    return read_serving(spark, f"{out}/serving")

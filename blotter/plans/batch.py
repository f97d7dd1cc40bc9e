"""Batch pipelines: enriched facts (Q4), monthly image (Q1/Q2), alerts (Q3)."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.config import PipelineConfig
from blotter.functions.parse import parse_records, with_event_time
from blotter.operators.anomaly import (alert_messages, alerts, anomaly_results, pane_start,
                                      sliding_counts, windows_from_panes)
from blotter.operators.enrich import enrich
from blotter.operators.monthly import (closed_months, counter_aggs, month_image, month_start_of,
                                      watermark_of)
from blotter.schema import COUNTERS
from blotter.session import checkpoint_root
from blotter.operators.running import running_counts


def enriched_incidents(records: DataFrame, codes: DataFrame,
                       cfg: PipelineConfig = PipelineConfig()) -> tuple[DataFrame, DataFrame]:
    """Q4: keyed records -> typed, event-timed, enriched incidents (+ rejects)."""
    incidents, rejects = parse_records(records, cfg.on_error)
    enriched = enrich(with_event_time(incidents), codes, max_rows=cfg.broadcast_max_rows,
                      max_bytes=cfg.broadcast_max_bytes, salt_buckets=cfg.salt_buckets)
    return enriched, rejects


def monthly_image(enriched: DataFrame, cfg: PipelineConfig = PipelineConfig(),
                  closed_only: bool = True) -> DataFrame:
    """Q1 (mode C): one row per complete month window and key."""
    image = month_image(enriched, "ts")
    if closed_only:
        image = closed_months(image, watermark_of(enriched, "ts", cfg.watermark_seconds))
    return image


def monthly_running(enriched: DataFrame, order: list[str], num_partitions: int | None = None) -> DataFrame:
    """Q2 (mode A): one output row per incident, holding the month's counters
    up to and including that incident (arrival order = ``order``)."""
    keyed = enriched.withColumn("month_start", month_start_of(F.col("ts")))
    run = running_counts(
        keyed, ["primary_description", "district", "month_start"], order,
        {"count": None, "count_arrest": "arrest", "count_domestic": "domestic",
         "count_monitored_by_fbi": "monitored_by_fbi"}, num_partitions)
    return run.withColumn("month", F.month("month_start"))


def anomaly_alerts(enriched: DataFrame, cfg: PipelineConfig = PipelineConfig(),
                   closed_only: bool = True) -> DataFrame:
    """Q3: alert rows of the sliding-window monitored share."""
    res = anomaly_results(sliding_counts(enriched, cfg.anomaly_period_days, cfg.anomaly_slide_days))
    wm = watermark_of(enriched, "ts", cfg.watermark_seconds) if closed_only else None
    return alerts(res, cfg.anomaly_threshold, wm)


def anomaly_alert_messages(enriched: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    return alert_messages(anomaly_alerts(enriched, cfg))


def image_and_alerts(enriched: DataFrame, cfg: PipelineConfig = PipelineConfig(),
                     ts_col: str = "ts", closed_only: bool = True) -> tuple[DataFrame, DataFrame]:
    """Q1 + Q3 over one read of the input.

    One aggregation with two grouping sets - (district, category, month) for
    the image and (district, pane) for the sliding windows - plus max(ts) for
    the final watermark: the incidents are scanned, parsed and joined once,
    and combined map-side before a single shuffle.  The aggregate is bounded
    by the key domain (districts x categories x months + districts x panes),
    so it is checkpointed to the shared folder and both outputs read it.
    Returns (month image - complete months only unless ``closed_only`` is
    False -, alert rows)."""
    ts = F.col(ts_col)
    keyed = enriched.select(
        "district", "primary_description", "arrest", "domestic", "monitored_by_fbi", ts.alias("_ts"),
        month_start_of(ts).alias("month_start"),
        pane_start(ts, cfg.anomaly_period_days, cfg.anomaly_slide_days).alias("_pane"))
    agg = (keyed.groupingSets([["district", "primary_description", "month_start"], ["district", "_pane"]],
                              "district", "primary_description", "month_start", "_pane")
           .agg(*counter_aggs(), F.max("_ts").alias("_max_ts"), F.grouping_id().alias("_gid")))
    checkpoint_root(enriched.sparkSession)
    agg = agg.checkpoint(eager=True)
    watermark = agg.select(F.max("_max_ts") - F.expr(f"INTERVAL {cfg.watermark_seconds} SECONDS")).scalar()
    # grouping_id bit is 1 for a column absent from the set (order: district, pd, month_start, _pane)
    image = (agg.where(F.col("_gid") == 1)
             .select("district", F.month("month_start").alias("month"), "primary_description", *COUNTERS,
                     "month_start", (F.col("month_start") + F.expr("INTERVAL 1 MONTH")).alias("month_end")))
    panes = agg.where(F.col("_gid") == 6).select(
        "district", "_pane", F.col("count").alias("_n"), F.col("count_monitored_by_fbi").alias("_m"))
    res = anomaly_results(windows_from_panes(panes, cfg.anomaly_period_days, cfg.anomaly_slide_days))
    if closed_only:
        image = closed_months(image, watermark)
    return image, alerts(res, cfg.anomaly_threshold, watermark)


def run_batch_job(spark, cfg: PipelineConfig, input_path: str, serving_path: str,
                  alert_path: str | None = None, alert_kafka: dict | None = None,
                  rejects_path: str | None = None) -> None:
    """The job over files at rest: serving table + alert log from one read.

    Mode C upserts complete months.  Mode A emits a row per incident; after a
    batch run only each key's last emission is visible in the table, which is
    the month's full count, so the unfiltered image is upserted.  Alerts and
    rejects go to a folder named after the input, which a rerun replaces."""
    from blotter.sinks.alerts import write_alert_log
    from blotter.sinks.serving import upsert_serving
    from blotter.sources.codes import load_code_table
    from blotter.sources.records import directory_lines, keyed_lines

    codes = load_code_table(spark, cfg.lookup_path, cfg.lookup_parse)
    enriched, rejects = enriched_incidents(keyed_lines(directory_lines(spark, input_path)), codes, cfg)
    image, alert_rows = image_and_alerts(enriched, cfg, closed_only=not cfg.emit_every_row)
    if cfg.keep_year:
        image = image.withColumn("year", F.year("month_start"))
    upsert_serving(image, serving_path, "month_end", cfg.keep_year)
    run = f"input={hashlib.sha1(input_path.rstrip('/').encode()).hexdigest()[:16]}"
    if alert_path:
        write_alert_log(alert_messages(alert_rows), f"{alert_path}/{run}", mode="overwrite")
    elif alert_kafka:
        write_alert_log(alert_messages(alert_rows), kafka_options=alert_kafka)
    if rejects_path:
        rejects.write.mode("overwrite").parquet(f"{rejects_path}/{run}")

"""Registered queries: each reads the given tables (or data Spark derives from
them) and has, where SQL can express it, an equivalent DuckDB oracle.

Outputs carry plain (zone-less) timestamps so they compare with the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.config import PipelineConfig
from blotter.functions.parse import parse_records, with_event_time
from blotter.operators.anomaly import alert_messages, anomaly_results, sliding_counts
from blotter.operators.enrich import enrich
from blotter.operators.running import running_counts
from blotter.plans import batch
from blotter.plans.standins import (lineitem_csv_records, lineitem_incidents, orders_incidents,
                                    part_code_lines, part_codes, table)
from blotter.session import checkpoint_root, ensure_utc, scratch_path
from blotter.sinks.alerts import write_alert_log
from blotter.sinks.serving import upsert_serving
from blotter.sources.codes import code_table_from_lines, load_code_table
from blotter.sources.read_models import read_alert_log, read_serving
from blotter.sources.records import keyed_lines, keyed_text

CFG = PipelineConfig()


def plain_timestamps(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
                       for f in df.schema.fields])


def _enriched_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    inc = with_event_time(lineitem_incidents(spark, sf_dir))
    return enrich(inc, part_codes(spark, sf_dir))


# ---------------------------------------------------------------- queries

def q_parse_csv_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published lines (varied text forms) parsed back to incidents."""
    ensure_utc(spark)
    records = keyed_lines(lineitem_csv_records(spark, sf_dir))
    good, _ = parse_records(records)
    return plain_timestamps(good.select("id", "date", "iucr_code", "arrest", "domestic", "district"))


def q_parse_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that cannot be typed go to the side output with a reason."""
    ensure_utc(spark)
    lines = lineitem_csv_records(spark, sf_dir)
    # damaged copies: a half district loses its digits, an open line its millis
    v = F.col("value")
    broken = lines.select(
        F.when(v.rlike(r",-?[0-9]+\.5,1\.0,41\.8,-87\.6$"),
               F.regexp_replace(v, r",-?[0-9]+\.5,1\.0,", ",,1.0,"))
        .when(v.rlike(r",true,[0-9.]+,1\.0,41\.8,-87\.6$"), F.regexp_replace(v, r"\.000Z,", "Z,"))
        .otherwise(v).alias("value"))
    _, rejects = parse_records(keyed_lines(broken))
    return rejects.select("key", "value", "reason")


def q_keyed_line_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8: 'key:line' console records parsed like topic records."""
    ensure_utc(spark)
    lines = lineitem_csv_records(spark, sf_dir)
    console = lines.select(F.concat(F.substring_index("value", ",", 1), F.lit(":"), F.col("value"))
                           .alias("value"))
    good, _ = parse_records(keyed_text(console))
    return plain_timestamps(good.select("id", "date", "iucr_code", "arrest", "domestic", "district"))


def q_lookup_scan_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code-table lines parsed, padded and verified."""
    return code_table_from_lines(part_code_lines(spark, sf_dir))


def q_lookup_missing_fails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A code table that is not there fails before any query starts; once
    written (the given parts as code lines) the same path is read."""
    path = scratch_path(spark, "codes")
    try:
        load_code_table(spark, path)
        failed = False
    except ValueError:
        failed = True
    part_code_lines(spark, sf_dir).write.text(path)
    return load_code_table(spark, path).df.agg(F.count("*").alias("codes")).withColumn("failed", F.lit(failed))


def q_enrich_left_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents left-joined to the measured, broadcast code table."""
    df = _enriched_lineitem(spark, sf_dir)
    return plain_timestamps(df.select("id", "ts", "iucr_code", "arrest", "domestic", "district",
                                      "primary_description", "monitored_by_fbi"))


def q_enrich_shuffle_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same join forced onto the shuffle path with salting (large code tables)."""
    ensure_utc(spark)
    inc = with_event_time(lineitem_incidents(spark, sf_dir))
    df = enrich(inc, part_codes(spark, sf_dir), broadcast=False, salt_buckets=4)
    return plain_timestamps(df.select("id", "ts", "iucr_code", "arrest", "domestic", "district",
                                      "primary_description", "monitored_by_fbi"))


def q_month_image_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every month window of the image."""
    return plain_timestamps(batch.monthly_image(_enriched_lineitem(spark, sf_dir), CFG, closed_only=False))


def q_month_image_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + T1: the month windows the final watermark has closed (mode C)."""
    return plain_timestamps(batch.monthly_image(_enriched_lineitem(spark, sf_dir), CFG, closed_only=True))


def q_month_image_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: per-row running counters of the month (mode A), arrival = (time, id)."""
    ensure_utc(spark)
    inc = with_event_time(orders_incidents(spark, sf_dir))
    run = batch.monthly_running(inc, ["ts", "id"])
    return plain_timestamps(run.select("id", "district", "month", "primary_description", "month_start",
                                       "count", "count_arrest", "count_domestic",
                                       "count_monitored_by_fbi"))


HOT_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
             "l_extendedprice", "l_discount", "l_tax", "l_linestatus"]


def q_running_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 where every key holds about a third of all rows: running counts of
    line items per return flag in ship order (ties broken by every column)."""
    li = table(spark, sf_dir, "lineitem").withColumn("is_open", F.col("l_linestatus") == "O")
    run = running_counts(li, ["l_returnflag"], HOT_ORDER, {"count": None, "count_open": "is_open"})
    return run.select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate", "count", "count_open")


def _upserted_serving(spark, sf_dir) -> str:
    """Closed month windows upserted in two rounds (emission order = window end)."""
    # the image is bounded by the key domain: materialise it once for both rounds
    checkpoint_root(spark)
    image = batch.monthly_image(_enriched_lineitem(spark, sf_dir), CFG, closed_only=True).checkpoint()
    path = scratch_path(spark, "serving")
    cut = F.lit("1998-07-01 00:00:00").cast("timestamp")
    upsert_serving(image.where(F.col("month_start") < cut), path, "month_end")
    upsert_serving(image.where(F.col("month_start") >= cut), path, "month_end")
    return path


def q_serving_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + S6: closed months upserted in two rounds; newest year per key."""
    return read_serving(spark, _upserted_serving(spark, sf_dir))


def q_serving_upsert_keep_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 with the year in the key: no year collision, one row per month window."""
    image = batch.monthly_image(_enriched_lineitem(spark, sf_dir), CFG, closed_only=True)
    image = image.withColumn("year", F.year("month_start"))
    path = scratch_path(spark, "serving-year")
    upsert_serving(image, path, "month_end", keep_year=True)
    return read_serving(spark, path, keep_year=True)


def q_serving_filtered_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Serving table read with a predicate (district partitions pruned)."""
    path = _upserted_serving(spark, sf_dir)
    return read_serving(spark, path, (F.col("district") == 7) & (F.col("month") >= 6))


def q_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every non-empty 30-day window per district."""
    w = sliding_counts(_enriched_lineitem(spark, sf_dir), CFG.anomaly_period_days, CFG.anomaly_slide_days)
    return plain_timestamps(w)


def q_anomaly_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4, P13, F2 + T1: closed windows above the 60% threshold."""
    return plain_timestamps(batch.anomaly_alerts(_enriched_lineitem(spark, sf_dir), CFG))


def q_anomaly_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert text lines of the closed alerts."""
    return batch.anomaly_alert_messages(_enriched_lineitem(spark, sf_dir), CFG)


def q_job_month_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch job, image output (one read of the input for image + alerts)."""
    image, _ = batch.image_and_alerts(_enriched_lineitem(spark, sf_dir), CFG)
    return plain_timestamps(image)


def q_job_alert_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch job, alert output (same single-pass aggregate)."""
    _, alert_rows = batch.image_and_alerts(_enriched_lineitem(spark, sf_dir), CFG)
    return alert_messages(alert_rows)


def q_alert_log_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 then S7: alert lines written to the log folder and read back."""
    path = scratch_path(spark, "alert-log")
    write_alert_log(batch.anomaly_alert_messages(_enriched_lineitem(spark, sf_dir), CFG), path)
    return read_alert_log(spark, path)


def q_anomaly_all_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every window's share (open windows included), threshold 50."""
    res = anomaly_results(sliding_counts(_enriched_lineitem(spark, sf_dir), 30, 1))
    return plain_timestamps(res.where(F.col("percentage_monitored_by_fbi") > 50.0))

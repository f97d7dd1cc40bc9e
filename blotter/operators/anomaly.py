"""Sliding-window share of monitored incidents.

Batch plan (pane sharing): incidents are first pre-aggregated per
(district, pane) where a pane is gcd(period, slide) long - a partial/final
hash aggregate, so a hot district is combined map-side.  Each pane row is
then expanded to the period/slide windows that contain it and summed again.
The expansion multiplies pane rows, never incident rows: its size is
districts x panes x windows-per-pane, bounded by the time span, not by the
number of incidents.  Windows are epoch aligned, [start, start + period).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions.format import alert_text, percentage

DAY = 86400


def pane_seconds(period_days: int, slide_days: int) -> int:
    return math.gcd(period_days * DAY, slide_days * DAY)


def pane_start(ts: Column, period_days: int = 30, slide_days: int = 1) -> Column:
    t = F.unix_seconds(ts)
    return t - F.pmod(t, F.lit(pane_seconds(period_days, slide_days)))


def windows_from_panes(panes: DataFrame, period_days: int = 30, slide_days: int = 1,
                       key: str = "district") -> DataFrame:
    """Pane rows (key, _pane, _n, _m) -> one row per non-empty window."""
    size, slide = period_days * DAY, slide_days * DAY
    per_window = math.ceil(size / slide)
    last_start = F.col("_pane") - F.pmod(F.col("_pane"), F.lit(slide))
    expanded = (panes
                .select(key, "_pane", "_n", "_m",
                        F.explode(F.sequence(F.lit(0), F.lit(per_window - 1))).alias("_k"))
                .select(key, "_n", "_m", "_pane",
                        (last_start - F.col("_k") * F.lit(slide)).alias("_s"))
                .where(F.col("_s") > F.col("_pane") - F.lit(size)))
    win = expanded.groupBy(key, "_s").agg(F.sum("_n").alias("count"),
                                          F.sum("_m").alias("count_monitored_by_fbi"))
    return win.select(
        F.timestamp_seconds(F.col("_s")).alias("start"),
        F.timestamp_seconds(F.col("_s") + F.lit(size)).alias("end"),
        F.col(key),
        F.col("count").cast("bigint").alias("count"),
        F.col("count_monitored_by_fbi").cast("bigint").alias("count_monitored_by_fbi"),
    )


def sliding_counts(enriched: DataFrame, period_days: int = 30, slide_days: int = 1,
                   ts_col: str = "ts", key: str = "district",
                   flag_col: str = "monitored_by_fbi") -> DataFrame:
    """(start, end, <key>, count, count_monitored_by_fbi) for every non-empty
    sliding window."""
    panes = (enriched
             .groupBy(F.col(key), pane_start(F.col(ts_col), period_days, slide_days).alias("_pane"))
             .agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col(flag_col)).alias("_m")))
    return windows_from_panes(panes, period_days, slide_days, key)


def anomaly_results(windows: DataFrame) -> DataFrame:
    """A4: window bounds + counters + percentage."""
    return windows.select(
        "start", "end", "district", "count", "count_monitored_by_fbi",
        percentage(F.col("count_monitored_by_fbi"), F.col("count")).alias("percentage_monitored_by_fbi"),
    )


def alerts(results: DataFrame, threshold: float = 60.0, watermark: Column | None = None) -> DataFrame:
    """F2 (+T1): strictly above the threshold; with ``watermark`` only windows
    whose end the watermark has reached."""
    out = results.where(F.col("percentage_monitored_by_fbi") > F.lit(float(threshold)))
    if watermark is not None:
        out = out.where(F.col("end") <= watermark)
    return out


def alert_messages(alert_rows: DataFrame) -> DataFrame:
    """One text line per alert, column ``value``."""
    return alert_rows.select(alert_text(
        F.col("start"), F.col("end"), F.col("district"), F.col("count"),
        F.col("count_monitored_by_fbi"), F.col("percentage_monitored_by_fbi")).alias("value"))

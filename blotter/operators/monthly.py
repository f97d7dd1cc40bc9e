"""Monthly image of counts per (category, district).

Calendar-month tumbling windows in UTC are ``date_trunc('month', ts)``; the
four counters are plain partial/final hash aggregates, so a hot key is
combined map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.schema import COUNTERS


def month_start_of(ts: Column) -> Column:
    return F.date_trunc("month", ts)


def counter_aggs() -> list[Column]:
    """count, count_arrest, count_domestic, count_monitored_by_fbi."""
    return [
        F.count(F.lit(1)).alias("count"),
        F.count_if(F.col("arrest")).alias("count_arrest"),
        F.count_if(F.col("domestic")).alias("count_domestic"),
        F.count_if(F.col("monitored_by_fbi")).alias("count_monitored_by_fbi"),
    ]


def month_image(enriched: DataFrame, ts_col: str = "ts") -> DataFrame:
    """One row per (district, month window, primary_description) with the
    window bounds, month number (1-12, no year) and four counters."""
    ms = month_start_of(F.col(ts_col))
    agg = (enriched.groupBy("district", "primary_description", ms.alias("month_start"))
           .agg(*counter_aggs()))
    return agg.select(
        "district",
        F.month("month_start").alias("month"),
        "primary_description",
        *COUNTERS,
        "month_start",
        (F.col("month_start") + F.expr("INTERVAL 1 MONTH")).alias("month_end"),
    )


def watermark_of(df: DataFrame, ts_col: str = "ts", delay_seconds: int = 86400) -> Column:
    """Final event-time watermark of a bounded input: max(ts) - delay, as a
    scalar subquery (one partial/final aggregate, no join)."""
    return df.select(F.max(ts_col) - F.expr(f"INTERVAL {int(delay_seconds)} SECONDS")).scalar()


def closed_months(image: DataFrame, watermark: Column) -> DataFrame:
    """Keep windows the watermark has passed (end <= watermark)."""
    return image.where(F.col("month_end") <= watermark)

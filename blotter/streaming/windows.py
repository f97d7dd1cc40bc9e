"""W1 / W2 / W3 / T1 / L1 on streams.

* W3: ``withWatermark`` on the event time (must be TIMESTAMP, not _NTZ).
* W1 (mode C): a calendar month has no fixed length, so ``window()`` cannot
  express it.  A session window whose gap is the time left until the end of
  the row's month gives every row of a month the same session end (the month
  end); adding the month start to the key keeps touching months apart.  In
  append mode a session is emitted once the watermark passes its end, and the
  late-row rule is by session (month) end: an old row whose month is still
  open is counted, a row whose month has been emitted is dropped (L1).
* W2: ``window(ts, period, slide)``, epoch aligned like the reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.operators.monthly import counter_aggs, month_start_of
from blotter.schema import COUNTERS


def with_watermark(df: DataFrame, ts_col: str = "ts", delay: str = "1 day") -> DataFrame:
    """Bounded out-of-orderness; NTZ event times are read as UTC."""
    if dict(df.dtypes)[ts_col] == "timestamp_ntz":
        df = df.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    return df.withWatermark(ts_col, delay)


def month_gap(ts_col: str = "ts"):
    """Dynamic session gap: seconds from the row's time to its month end."""
    return F.expr(
        f"make_interval(0, 0, 0, 0, 0, 0, unix_seconds(date_trunc('month', {ts_col}) + INTERVAL 1 MONTH)"
        f" - unix_seconds({ts_col}))")


def month_image_stream(enriched: DataFrame, ts_col: str = "ts") -> DataFrame:
    """A1 over W1 with the on-complete trigger (T1); append output mode.

    Sessions are merged inside each input partition before the shuffle, so a
    hot key sends one partial session per partition, not all of its rows."""
    enriched.sparkSession.conf.set(
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    agg = (enriched
           .groupBy("district", "primary_description", month_start_of(F.col(ts_col)).alias("month_start"),
                    F.session_window(F.col(ts_col), month_gap(ts_col)).alias("_session"))
           .agg(*counter_aggs()))
    return agg.select(
        "district", F.month("month_start").alias("month"), "primary_description", *COUNTERS,
        "month_start", F.col("_session.end").alias("month_end"))


def sliding_counts_stream(enriched: DataFrame, period_days: int = 30, slide_days: int = 1,
                          ts_col: str = "ts", key: str = "district",
                          aggs: list | None = None) -> DataFrame:
    """A2 over W2; emitted when the watermark passes the window end."""
    aggs = aggs or [F.count(F.lit(1)).alias("count"),
                    F.count_if(F.col("monitored_by_fbi")).alias("count_monitored_by_fbi")]
    w = F.window(F.col(ts_col), f"{period_days} days", f"{slide_days} days")
    agg = enriched.groupBy(F.col(key), w.alias("_w")).agg(*aggs)
    names = [c for c in agg.columns if c not in (key, "_w")]
    return agg.select(F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), key, *names)

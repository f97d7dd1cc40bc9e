"""W2 / T1 / L1 on streams: sliding windows from a state of panes.

A pane is one (district, day) with its two counters (in general, one per gcd of period
and slide).  Rows are added to their panes with a map-side combine, so a row is counted
once, not once per window.  When the watermark moves, the windows whose end it
passed are summed from the panes: their number follows the days that it moved over and
the districts, not the rows.

A late row is judged per window: it is added to its pane, where only windows that are
still open meet it; the windows that closed before have been emitted and are not
again.  A pane leaves the state when the last window that holds it has closed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.operators.anomaly import DAY, pane_seconds, windows_from_panes
from blotter.streaming.statelog import COMPACT_EVERY, Ledger, StateLog

PANES = T.StructType([T.StructField("district", T.IntegerType()), T.StructField("_pane", T.LongType()),
                      T.StructField("_n", T.LongType()), T.StructField("_m", T.LongType())])


class SlidingPanes:
    """Pane state of windows of ``period_days`` every ``slide_days``."""

    def __init__(self, path: str, period_days: int, slide_days: int, compact_every: int = COMPACT_EVERY):
        self.period_days, self.slide_days = period_days, slide_days
        self.size, self.slide = period_days * DAY, slide_days * DAY
        self.pane = pane_seconds(period_days, slide_days)
        self.log = StateLog(path, PANES, ["district", "_pane"], compact_every)

    def last_end(self, seconds: Column) -> Column:
        """End of the last window that holds a time."""
        return seconds - F.pmod(seconds, F.lit(self.slide)) + F.lit(self.size)

    def closed_windows(self, seconds: Column, watermark_ms: int | None) -> Column:
        """How many of the windows that hold a time end at or before the watermark."""
        if watermark_ms is None:
            return F.lit(0).cast("bigint")
        last = F.least(seconds, F.lit(watermark_ms // 1000 - self.size))
        return F.greatest(F.lit(0), F.floor(last / self.slide) - F.floor((seconds - F.lit(self.size)) / self.slide)).cast("bigint")

    def open_panes(self, watermark_ms: int | None) -> Column:
        return F.lit(True) if watermark_ms is None else self.last_end(F.col("_pane")) > F.lit(watermark_ms // 1000)

    def increments(self, rows: DataFrame, watermark_ms: int | None) -> DataFrame:
        """Counters of staged ``rows`` (event_ms, district, monitored_by_fbi) by pane."""
        seconds = F.floor(F.col("event_ms") / 1000).cast("bigint")
        return (rows.groupBy("district", (seconds - F.pmod(seconds, F.lit(self.pane))).alias("_pane"))
                .agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col("monitored_by_fbi")).alias("_m"))
                .where(self.open_panes(watermark_ms)))

    def passes_an_end(self, before_ms: int | None, after_ms: int | None) -> bool:
        if after_ms is None:
            return False
        return before_ms is None or (after_ms // 1000 - self.size) // self.slide > (before_ms // 1000 - self.size) // self.slide

    def closing(self, state: DataFrame, before_ms: int | None, after_ms: int) -> DataFrame:
        """The windows that end after ``before_ms`` and at or before ``after_ms``."""
        found = windows_from_panes(state.where(self.open_panes(before_ms)), self.period_days, self.slide_days)
        ends = F.unix_millis("end")
        return found.where((ends <= F.lit(after_ms)) & (F.lit(True) if before_ms is None else ends > F.lit(before_ms)))

    def advance(self, rows: DataFrame, epoch: int, before_ms: int | None, after_ms: int | None) -> DataFrame | None:
        """Add the staged ``rows`` of a micro-batch; the windows that it closed, or None where the
        watermark passed no window's end."""
        spark = rows.sparkSession
        self.log.held(spark, epoch, self.open_panes(before_ms))
        self.log.append(self.increments(rows, before_ms), epoch)
        return self.closing(self.log.after(spark, epoch), before_ms, after_ms) if self.passes_an_end(before_ms, after_ms) else None


class SlidingImage:
    """``foreachBatch`` function of sliding window counts: ``sink`` gets (closed windows, epoch)
    of the micro-batches that closed some; it must be idempotent per epoch."""

    def __init__(self, state: str, sink: Callable[[DataFrame, int], None], delay_seconds: int, period_days: int = 30,
                 slide_days: int = 1, ts_col: str = "ts", compact_every: int = COMPACT_EVERY):
        self.sink, self.ts_col = sink, ts_col
        self.ledger = Ledger(state, delay_seconds)
        self.panes = SlidingPanes(f"{state}/panes", period_days, slide_days, compact_every)

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        mark = self.ledger.before(spark, epoch)
        rows = batch.select(F.unix_millis(self.ts_col).alias("event_ms"), "district", "monitored_by_fbi")
        staged, seen = self.ledger.stage(rows, epoch, observed={
            "largest": F.max("event_ms"),
            "late": F.coalesce(F.sum(self.panes.closed_windows(F.floor(F.col("event_ms") / 1000).cast("bigint"), mark.watermark_ms)), F.lit(0))})
        watermark = self.ledger.watermark(staged, seen["largest"], mark, epoch)
        windows = self.panes.advance(staged, epoch, mark.watermark_ms, watermark)
        if windows is not None:
            self.sink(windows, epoch)
        self.ledger.commit(spark, epoch, replace(mark, watermark_ms=watermark, late_windows=mark.late_windows + seen["late"]))

"""Q4 on streams: one enriched micro-batch for all outputs of the job.

A micro-batch is read, parsed and joined with the code table once and staged; the
monthly image, the alerts and the rejects are made of the staged rows.  Months and
panes are state logs (:mod:`~blotter.streaming.statelog`), one mark ends the micro-batch for all
of them, so the outputs share one watermark and one recovery point.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions.parse import with_event_time
from blotter.operators.anomaly import alert_messages, alerts, anomaly_results
from blotter.operators.enrich import enrich, hot_codes
from blotter.session import shuffles_for_rows
from blotter.streaming.panes import PANES, SlidingPanes
from blotter.streaming.statelog import COMPACT_EVERY, Ledger
from blotter.streaming.stateful import closed, month_columns, month_increments, month_log, month_rows, passed, running_rows

Sink = Callable[[DataFrame, int], None]


@dataclass
class Join:
    """How a micro-batch meets the code table (see :func:`~blotter.operators.enrich.enrich`)."""
    codes: object
    max_rows: int
    max_bytes: int
    salt_buckets: int = 0

    @property
    def broadcasts(self) -> bool:
        return self.codes.broadcastable(self.max_rows, self.max_bytes)

    def __call__(self, incidents: DataFrame, hot: DataFrame | None = None) -> DataFrame:
        return enrich(incidents, self.codes, max_rows=self.max_rows, max_bytes=self.max_bytes,
                      salt_buckets=self.salt_buckets, hot=hot)


class JobBatch:
    """``foreachBatch`` function of the job over ``classified_records``.

    ``serving``: sink of (monthly rows with an emission order column, epoch); ``alert_lines``
    and ``rejects``: sinks of rows, or None.  All must be idempotent per epoch."""

    def __init__(self, path: str, join: Join, delay_seconds: int, serving: Sink, alert_lines: Sink | None = None,
                 rejects: Sink | None = None, every_row: bool = False, period_days: int = 30, slide_days: int = 1,
                 threshold: float = 60.0, arrival_col: str | None = None, partition_col: str | None = None,
                 partitions: int = 1, compact_every: int = COMPACT_EVERY):
        self.path, self.join, self.every_row, self.threshold = path, join, every_row, threshold
        self.serving, self.alert_lines, self.rejects = serving, alert_lines, rejects
        self.arrival_col, self.partition_col = arrival_col, partition_col
        self.ledger = Ledger(path, delay_seconds, partition_col, partitions)
        self.months = month_log(f"{path}/months", compact_every)
        self.panes = SlidingPanes(f"{path}/panes", period_days, slide_days, compact_every)

    def _stage(self, batch: DataFrame, epoch: int, observed: dict[str, Column]) -> tuple[DataFrame, dict]:
        """Typed rows joined with the code table, staged.  A join that shuffles runs over staged
        rows, so that hot codes can be found and its partitions sized first, and the source is
        still read once."""
        spark, events = batch.sparkSession, with_event_time(batch)
        if self.join.broadcasts or self.join.salt_buckets > 1:
            return self.ledger.stage(self._staged_columns(self.join(events)), epoch, observed=observed)
        rows, parsed = self.ledger.stage(events, epoch, "parsed")
        with shuffles_for_rows(spark, parsed["rows"]):
            enriched = self.join(rows, hot_codes(rows, int(spark.conf.get("spark.sql.shuffle.partitions"))))
            return self.ledger.stage(self._staged_columns(enriched), epoch, observed=observed)

    def _staged_columns(self, enriched: DataFrame) -> DataFrame:
        more = [F.col(self.partition_col)] if self.partition_col else []
        return enriched.select(
            "id", "primary_description", "district", "arrest", "domestic", "monitored_by_fbi", *month_columns(F.col("ts")),
            (F.col(self.arrival_col) if self.arrival_col else F.unix_millis("ts")).alias("arrival"), *more, "reason", "key", "value")

    def _observed(self, late: Column, watermark_ms: int | None) -> dict[str, Column]:
        good = F.col("reason").isNull()
        seconds = F.floor(F.col("event_ms") / 1000).cast("bigint")
        windows = self.panes.closed_windows(seconds, watermark_ms)
        return {"rejected": F.count_if(~good), "largest": F.max(F.when(good, F.col("event_ms"))),
                "late": F.count_if(good & late), "late_windows": F.coalesce(F.sum(F.when(good, windows)), F.lit(0))}

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        mark = self.ledger.before(spark, epoch)
        late = closed("month_end_ms", mark.watermark_ms)
        staged, seen = self._stage(batch, epoch, self._observed(late, mark.watermark_ms))
        good = staged.where("reason is null")
        if self.rejects is not None and (seen["rejected"] or epoch == 0):
            self.rejects(staged.where("reason is not null").select("key", "value", "reason"), epoch)
        with shuffles_for_rows(spark, seen["rows"]):
            watermark = self.ledger.watermark(good, seen["largest"], mark, epoch)
            self._months(good.where(~late), seen["rows"], epoch, mark.watermark_ms, watermark)
            if self.alert_lines is not None:
                self._windows(good, epoch, mark.watermark_ms, watermark)
        self.ledger.commit(spark, epoch, replace(
            mark, watermark_ms=watermark, late_rows=mark.late_rows + seen["late"], late_windows=mark.late_windows + seen["late_windows"]))

    def _months(self, live: DataFrame, n: int, epoch: int, before: int | None, after: int | None) -> None:
        spark = live.sparkSession
        held = self.months.held(spark, epoch, ~closed("month_end_ms", before))
        if self.every_row:
            rows = running_rows(live, held, f"{self.path}/range", n)
            self.serving(rows.withColumn("_order", F.struct("month_start", "count")), epoch)
        self.months.append(month_increments(live), epoch)
        if not self.every_row and _month(after) != _month(before):
            rows = month_rows(self.months.after(spark, epoch).where(passed("month_end_ms", before, after)))
            self.serving(rows.withColumn("_order", F.col("month_end")), epoch)

    def _windows(self, good: DataFrame, epoch: int, before: int | None, after: int | None) -> None:
        windows = self.panes.advance(good, epoch, before, after)
        if windows is None and epoch == 0:
            windows = self.panes.closing(good.sparkSession.createDataFrame([], PANES), None, 0)     # the log exists from the start
        if windows is not None:
            self.alert_lines(alert_messages(alerts(anomaly_results(windows), self.threshold)), epoch)


def _month(ms: int | None) -> tuple | None:
    if ms is None:
        return None
    at = dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc)
    return at.year, at.month

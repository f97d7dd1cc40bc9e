"""Months on streams without stateful operators: one output row per incoming
incident (T2 / A3, mode A), or one per complete month (T1, mode C).

Both run in ``foreachBatch`` over a :class:`~blotter.streaming.statelog.StateLog` of open
(category, district, month) keys with their four counters, so a key's state lives as
long as its month is open, a micro-batch writes only the keys that it touches,
and a query may be resumed with any number of partitions.

Mode A: the open-month rows of a micro-batch get running counters with the
distributed prefix sum of :func:`~blotter.operators.running.running_counts` (arrival order
over the whole micro-batch, a hot key spans many tasks), to which the
counters that its keys had before are added by a join.  Mode C: the keys whose
month end the watermark passed are emitted after the micro-batch that moved it.

Rows of a closed month (month end at or before the watermark that the micro-batch
started with) are dropped and counted (L1).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.operators.running import running_counts
from blotter.schema import COUNTERS
from blotter.session import shuffles_for_rows
from blotter.streaming.statelog import COMPACT_EVERY, Ledger, StateLog, last_mark

KEY_COLS = ["primary_description", "district", "month_start_ms", "month_end_ms"]
FLAGS = {"count": None, "count_arrest": "arrest", "count_domestic": "domestic",
         "count_monitored_by_fbi": "monitored_by_fbi"}
STATE = T.StructType([T.StructField("primary_description", T.StringType()), T.StructField("district", T.IntegerType()),
                      T.StructField("month_start_ms", T.LongType()), T.StructField("month_end_ms", T.LongType())]
                     + [T.StructField(c, T.LongType()) for c in COUNTERS])


def month_columns(ts: Column) -> list[Column]:
    """event_ms, month_start_ms and month_end_ms of an event time."""
    month = F.date_trunc("month", ts)
    return [F.unix_millis(ts).alias("event_ms"), F.unix_millis(month).alias("month_start_ms"),
            F.unix_millis(month + F.expr("INTERVAL 1 MONTH")).alias("month_end_ms")]


def prepared(batch: DataFrame, ts_col: str, arrival_col: str | None, partition_col: str | None = None) -> DataFrame:
    """The columns that months need; ``arrival`` orders the rows of a micro-batch."""
    more = [F.col(partition_col)] if partition_col else []
    return batch.select(
        "id", "primary_description", "district", "arrest", "domestic", "monitored_by_fbi", *month_columns(F.col(ts_col)),
        (F.col(arrival_col) if arrival_col else F.unix_millis(F.col(ts_col))).alias("arrival"), *more)


def closed(end_ms: str, watermark_ms: int | None) -> Column:
    return F.lit(False) if watermark_ms is None else F.col(end_ms) <= F.lit(watermark_ms)


def month_log(path: str, compact_every: int = COMPACT_EVERY) -> StateLog:
    return StateLog(path, STATE, KEY_COLS, compact_every)


def month_increments(live: DataFrame) -> DataFrame:
    ones = {c: F.lit(1) if src is None else F.coalesce(F.col(src), F.lit(False)).cast("bigint") for c, src in FLAGS.items()}
    return live.groupBy(*KEY_COLS).agg(*[F.sum(one).cast("bigint").alias(c) for c, one in ones.items()])


def running_rows(live: DataFrame, held: DataFrame, scratch: str, rows: int | None = None) -> DataFrame:
    """A3: each of the (at most ``rows``) rows with its month's counters up to and including
    it; ``held`` are those of earlier micro-batches."""
    run = running_counts(live, KEY_COLS, ["arrival", "id"], FLAGS, scratch=scratch, rows=rows)
    base = held.select(*[F.col(c).alias("_" + c) for c in STATE.names])
    same = [F.col(c).eqNullSafe(F.col("_" + c)) for c in KEY_COLS]
    return run.join(base, same, "left").select(
        "id", "district", F.month(F.timestamp_millis("month_start_ms")).alias("month"), "primary_description",
        F.timestamp_millis("month_start_ms").alias("month_start"), "arrival",
        *[(F.col(c) + F.coalesce(F.col("_" + c), F.lit(0))).alias(c) for c in COUNTERS])


def month_rows(state: DataFrame) -> DataFrame:
    """State keys as rows of the monthly image."""
    start = F.timestamp_millis("month_start_ms")
    return state.select("district", F.month(start).alias("month"), "primary_description", *COUNTERS,
                        start.alias("month_start"), F.timestamp_millis("month_end_ms").alias("month_end"))


def passed(end_ms: str, before: int | None, after: int | None) -> Column:
    """Ends that a move of the watermark passed."""
    return closed(end_ms, after) & ~closed(end_ms, before)


class MonthImage:
    """``foreachBatch`` function of the monthly image, mode A (``every_row``) or C.

    ``state``: folder below the query's ``checkpointLocation``; ``sink``:
    called with (rows, epoch) for every micro-batch, must be idempotent per
    epoch; ``delay_seconds``: the watermark delay; ``partition_col``, ``partitions``: see
    :class:`~blotter.streaming.statelog.Ledger`."""

    def __init__(self, state: str, sink: Callable[[DataFrame, int], None], delay_seconds: int, every_row: bool = False,
                 ts_col: str = "ts", arrival_col: str | None = None, partition_col: str | None = None, partitions: int = 1,
                 compact_every: int = COMPACT_EVERY):
        self.state, self.sink, self.every_row = state, sink, every_row
        self.ts_col, self.arrival_col, self.partition_col = ts_col, arrival_col, partition_col
        self.ledger = Ledger(state, delay_seconds, partition_col, partitions)
        self.months = month_log(f"{state}/months", compact_every)

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        mark = self.ledger.before(spark, epoch)
        late = closed("month_end_ms", mark.watermark_ms)
        rows, seen = self.ledger.stage(prepared(batch, self.ts_col, self.arrival_col, self.partition_col), epoch,
                                       observed={"largest": F.max("event_ms"), "late": F.count_if(late)})
        live = rows.where(~late)
        with shuffles_for_rows(spark, seen["rows"]):
            held = self.months.held(spark, epoch, ~late)
            if self.every_row:
                self.sink(running_rows(live, held, f"{self.state}/range", seen["rows"]), epoch)
            self.months.append(month_increments(live), epoch)
            watermark = self.ledger.watermark(rows, seen["largest"], mark, epoch)
            if not self.every_row:
                self.sink(month_rows(self.months.after(spark, epoch).where(passed("month_end_ms", mark.watermark_ms, watermark))), epoch)
        self.ledger.commit(spark, epoch, replace(mark, watermark_ms=watermark, late_rows=mark.late_rows + seen["late"]))

    def late_rows(self, spark: SparkSession) -> int:
        """Rows dropped so far because their month had closed (L1), over all runs of the query."""
        return last_mark(spark, self.state).late_rows


class PerRowImage(MonthImage):
    """:class:`MonthImage` in mode A."""

    def __init__(self, state: str, sink: Callable[[DataFrame, int], None], delay_seconds: int, **options):
        super().__init__(state, sink, delay_seconds, every_row=True, **options)


def parquet_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Rows of every micro-batch in a folder of its own, replaced on replay."""
    def write(rows: DataFrame, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
    return write

"""W2, A2, A4, P13, F2, P15 on the sample rows (batch)."""

import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from blotter.config import PipelineConfig
from blotter.operators.anomaly import anomaly_results, sliding_counts
from blotter.operators.monthly import watermark_of
from blotter.plans import batch
from blotter.sources.codes import read_code_table
from tests import fixtures as FX
from tests.conftest import records_df


def _enriched(spark, code_file):
    enr, _ = batch.enriched_incidents(records_df(spark, FX.FILE_1 + FX.FILE_2),
                                      read_code_table(spark, code_file))
    return enr


def test_all_windows_golden(spark, code_file):
    enr = _enriched(spark, code_file)
    res = anomaly_results(sliding_counts(enr, 30, 1)).collect()
    assert len(res) == FX.WINDOWS
    got = Counter((r["count"], r.count_monitored_by_fbi, r.percentage_monitored_by_fbi) for r in res)
    want = Counter()
    for n, m, p, k, _, _ in FX.SLIDING:
        want[(n, m, p)] += k
    assert got == want
    first = min(res, key=lambda r: r.start)
    assert first.start == dt.datetime(2020, 12, 6) and first.end == dt.datetime(2021, 1, 5)
    closed = [r for r in res if r.end <= dt.datetime(2021, 4, 22)]
    assert len(closed) == FX.CLOSED_WINDOWS


def test_alert_thresholds(spark, code_file):
    enr = _enriched(spark, code_file)
    for th, n in [(60, FX.ALERTS), (50, FX.ALERTS), (110, 0)]:
        assert batch.anomaly_alerts(enr, PipelineConfig(anomaly_threshold=th)).count() == n
    opened = batch.anomaly_alerts(enr, PipelineConfig(anomaly_threshold=50), closed_only=False)
    assert opened.count() == FX.OPEN_ABOVE_50
    assert opened.where(F.col("percentage_monitored_by_fbi") == 60.0).count() == FX.EXACTLY_60
    at_60 = batch.anomaly_alerts(enr, PipelineConfig(anomaly_threshold=60), closed_only=False)
    assert at_60.count() == FX.OPEN_ABOVE_60
    assert at_60.where(F.col("percentage_monitored_by_fbi") == 60.0).count() == 0


def test_alert_text(spark, code_file):
    msgs = [r.value for r in batch.anomaly_alert_messages(_enriched(spark, code_file)).collect()]
    assert FX.FIRST_ALERT in msgs and len(msgs) == FX.ALERTS


def test_pane_sharing_matches_direct_windows(spark, code_file):
    """Batch pane plan == one-row-per-window expansion, also for a slide that
    does not divide the period."""
    enr = _enriched(spark, code_file)
    for period, slide in [(30, 1), (7, 2), (10, 4)]:
        fast = {(r.start, r["count"], r.count_monitored_by_fbi) for r in sliding_counts(enr, period, slide).collect()}
        w = F.window("ts", f"{period} days", f"{slide} days")
        slow = {(r.w.start, r.n, r.m) for r in enr.groupBy("district", w.alias("w")).agg(
            F.count("*").alias("n"), F.count_if("monitored_by_fbi").alias("m")).collect()}
        assert fast == slow, (period, slide)


def test_local_datetime_text(spark):
    from blotter.functions.format import local_datetime_text
    df = spark.createDataFrame([(dt.datetime(2023, 1, 3),), (dt.datetime(2023, 1, 3, 4, 5, 6),),
                                (dt.datetime(2023, 1, 3, 4, 5, 6, 120000),),
                                (dt.datetime(2023, 1, 3, 4, 5, 6, 123400),)], "t timestamp")
    got = [r[0] for r in df.select(local_datetime_text(F.col("t"))).collect()]
    assert got == ["2023-01-03T00:00", "2023-01-03T04:05:06", "2023-01-03T04:05:06.120",
                   "2023-01-03T04:05:06.123400"]


def test_watermark_scalar(spark, code_file):
    enr = _enriched(spark, code_file)
    assert enr.select(watermark_of(enr).alias("w")).first().w == dt.datetime(2021, 4, 22, 0, 30)

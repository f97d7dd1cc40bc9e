"""A1, W1, T1, P11, P12 on the sample rows (batch)."""

import datetime as dt

from blotter.config import PipelineConfig
from blotter.plans import batch
from blotter.sources.codes import read_code_table
from tests import fixtures as FX
from tests.conftest import records_df


def _enriched(spark, code_file, lines):
    enr, rej = batch.enriched_incidents(records_df(spark, lines), read_code_table(spark, code_file))
    assert rej.count() == 0
    return enr


def test_monthly_image_all_and_closed(spark, code_file):
    enr = _enriched(spark, code_file, FX.FILE_1 + FX.FILE_2)
    img = {r.month: (r["count"], r.count_arrest, r.count_domestic, r.count_monitored_by_fbi)
           for r in batch.monthly_image(enr, closed_only=False).collect()}
    assert img == FX.MONTHLY
    closed = {r.month for r in batch.monthly_image(enr, closed_only=True).collect()}
    assert closed == {1, 2, 3}          # April still open at watermark 2021-04-22


def test_month_edge_not_merged(spark, code_file):
    lines = ["1,2023-01-31T23:59:59.999Z,0110,true,false,1.0,1,1,1",
             "2,2023-02-01T00:00:00.000Z,0110,true,false,1.0,1,1,1"]
    rows = batch.monthly_image(_enriched(spark, code_file, lines), closed_only=False).collect()
    assert sorted((r.month, r["count"]) for r in rows) == [(1, 1), (2, 1)]
    jan = [r for r in rows if r.month == 1][0]
    assert jan.month_start == dt.datetime(2023, 1, 1) and jan.month_end == dt.datetime(2023, 2, 1)


def test_unknown_code_still_counted(spark, code_file):
    lines = ["1,2023-01-05T00:00:00.000Z,9999,true,false,1.0,1,1,1"]
    rows = batch.monthly_image(_enriched(spark, code_file, lines), closed_only=False).collect()
    assert [(r.primary_description, r["count"], r.count_monitored_by_fbi) for r in rows] == [("", 1, 0)]


def test_watermark_config(spark, code_file):
    enr = _enriched(spark, code_file, FX.FILE_1 + FX.FILE_2)
    cfg = PipelineConfig(watermark="30 days")    # 04-23 - 30 days = 03-24: March still open
    closed = {r.month for r in batch.monthly_image(enr, cfg, closed_only=True).collect()}
    assert closed == {1, 2}

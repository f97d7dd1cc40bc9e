"""Streaming forms: directory replay (S2), watermark (W3), month windows (W1,
T1), sliding windows (W2), late rows (L1), checkpoint resume (R1, R2), mode A
(T2), alert text sink (K2) and serving upsert (K1); stream == batch."""

import os

from blotter.functions.parse import parse_records, with_event_time
from blotter.operators.anomaly import alert_messages, alerts, anomaly_results
from blotter.operators.enrich import enrich
from blotter.sinks.alerts import alert_stream_writer
from blotter.sinks.serving import serving_batch_writer
from blotter.sources.codes import read_code_table
from blotter.sources.read_models import read_alert_log, read_serving
from blotter.sources.records import directory_lines, keyed_lines
from blotter.streaming.runner import run_available_now
from blotter.streaming.stateful import PerRowImage, parquet_sink
from blotter.streaming.windows import month_image_stream, sliding_counts_stream, with_watermark
from tests import fixtures as FX
from tests.conftest import _write


def _events(spark, src_dir, code_file, files_per_trigger=1):
    lines = directory_lines(spark, src_dir, streaming=True, files_per_trigger=files_per_trigger)
    inc, _ = parse_records(keyed_lines(lines))
    ev = with_watermark(with_event_time(inc), "ts", "1 day")
    return enrich(ev, read_code_table(spark, code_file))


def test_directory_lines_keep_raw_text(spark, incident_dir, tmp_dir):
    vals = [r.value for r in directory_lines(spark, incident_dir).collect()]
    assert sorted(vals) == sorted(FX.FILE_1 + FX.FILE_2)
    odd = ['20,2023-05-01T00:00:00.000Z,0110,True,False,"",1.0,1.0,1.0',
           "21,2023-05-01T00:00:00.000Z,0110,True,False,,1.0,1.0,1.0",
           '22,"a, b",x,,,, ,']
    _write(f"{tmp_dir}/odd.csv", [FX.HEADER] + odd)
    assert sorted(r.value for r in directory_lines(spark, f"{tmp_dir}/odd.csv").collect()) == sorted(odd)


def test_month_stream_closed_months(spark, incident_dir, code_file, tmp_dir):
    out = f"{tmp_dir}/out"
    run_available_now(month_image_stream(_events(spark, incident_dir, code_file)), f"{tmp_dir}/chk", out)
    got = {r.month: (r["count"], r.count_arrest, r.count_domestic, r.count_monitored_by_fbi)
           for r in spark.read.parquet(out).collect()}
    assert got == {m: FX.MONTHLY[m] for m in (1, 2, 3)}


def test_sliding_stream_alerts_and_text(spark, incident_dir, code_file, tmp_dir):
    res = anomaly_results(sliding_counts_stream(_events(spark, incident_dir, code_file), 30, 1))
    out = f"{tmp_dir}/windows"
    run_available_now(res, f"{tmp_dir}/chk", out)
    assert spark.read.parquet(out).count() == FX.CLOSED_WINDOWS          # closed windows only
    log = f"{tmp_dir}/log"
    msgs = alert_messages(alerts(anomaly_results(sliding_counts_stream(
        _events(spark, incident_dir, code_file), 30, 1)), 60.0))
    q = alert_stream_writer(msgs, f"{tmp_dir}/chk2", path=log).trigger(availableNow=True).start()
    q.awaitTermination()
    texts = [r.value for r in read_alert_log(spark, log).collect()]
    assert len(texts) == FX.ALERTS and FX.FIRST_ALERT in texts


def test_late_rows_and_resume(spark, code_file, tmp_dir):
    """Run 1: Jan + Feb rows.  Run 2 (resumed): a Jan row (month closed -> dropped),
    an old Feb row (older than the watermark but month open -> counted), and a
    March row that closes February."""
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    row = "{i},{d},0310,True,False,4.0,1.0,1.0,1.0"
    _write(f"{src}/a.csv", [FX.HEADER, row.format(i=1, d="2023-01-10T00:00:00.000Z"),
                            row.format(i=2, d="2023-02-20T00:00:00.000Z")], 1_700_000_000)
    out, chk = f"{tmp_dir}/out", f"{tmp_dir}/chk"
    img = month_image_stream(_events(spark, src, code_file))
    run_available_now(img, chk, out)
    assert [(r.month, r["count"]) for r in spark.read.parquet(out).collect()] == [(1, 1)]
    _write(f"{src}/b.csv", [FX.HEADER, row.format(i=3, d="2023-01-30T00:00:00.000Z"),
                            row.format(i=4, d="2023-02-02T00:00:00.000Z"),
                            row.format(i=5, d="2023-03-05T00:00:00.000Z")], 1_700_000_100)
    q = run_available_now(img, chk, out)                   # same checkpoint: resumes
    got = sorted((r.month, r["count"]) for r in spark.read.parquet(out).collect())
    assert got == [(1, 1), (2, 2)]
    from blotter.streaming.metrics import late_rows_dropped
    assert late_rows_dropped(q) == 1                       # the January row


def _mode_a(spark, src, code_file, tmp_dir, name="a"):
    """One run of mode A over what is there; returns all rows emitted so far."""
    lines = directory_lines(spark, src, streaming=True)
    inc, _ = parse_records(keyed_lines(lines))
    events = enrich(with_event_time(inc), read_code_table(spark, code_file))
    out, chk = f"{tmp_dir}/out-{name}", f"{tmp_dir}/chk-{name}"
    run_available_now(events, chk, foreach_batch=PerRowImage(f"{chk}/per-row", parquet_sink(out), 86400, arrival_col="id"))
    return sorted(spark.read.parquet(out).collect(), key=lambda r: r.id)


def test_mode_a_stream_one_row_per_incident(spark, incident_dir, code_file, tmp_dir):
    got = _mode_a(spark, incident_dir, code_file, tmp_dir)
    assert [r["count"] for r in got] == FX.RUNNING
    assert [r.count_monitored_by_fbi for r in got if r.month == 4] == FX.RUNNING_MONITORED_APRIL


def test_stream_serving_upsert_equals_batch(spark, incident_dir, code_file, tmp_dir):
    table = f"{tmp_dir}/serving"
    img = month_image_stream(_events(spark, incident_dir, code_file))
    run_available_now(img, f"{tmp_dir}/chk", foreach_batch=serving_batch_writer(table, "month_end"))
    got = {r.month: (r["count"], r.count_arrest, r.count_domestic, r.count_monitored_by_fbi)
           for r in read_serving(spark, table).collect()}
    assert got == {m: FX.MONTHLY[m] for m in (1, 2, 3)}


def test_order_independence_within_watermark(spark, code_file, tmp_dir):
    """Any arrival order within 1 day gives the same closed windows."""
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    lines = FX.FILE_1 + FX.FILE_2
    _write(f"{src}/a.csv", [FX.HEADER] + lines[:6], 1_700_000_000)
    _write(f"{src}/b.csv", [FX.HEADER] + list(reversed(lines[6:])), 1_700_000_100)
    out = f"{tmp_dir}/out"
    run_available_now(anomaly_results(sliding_counts_stream(_events(spark, src, code_file), 30, 1)),
                      f"{tmp_dir}/chk", out)
    assert spark.read.parquet(out).count() == FX.CLOSED_WINDOWS


def test_publish_lines_file_twin_round_trip(spark, tmp_dir):
    from blotter.sources.records import publish_lines
    lines = spark.createDataFrame([(v,) for v in FX.FILE_1], "value string")
    publish_lines(lines, path=f"{tmp_dir}/topic")
    back = sorted(r.value for r in directory_lines(spark, f"{tmp_dir}/topic").collect())
    assert back == sorted(FX.FILE_1)
    keys = sorted(int(r.key) for r in keyed_lines(directory_lines(spark, f"{tmp_dir}/topic")).collect())
    assert keys == list(range(101, 107))


def test_state_partitions_bounded_and_restored(spark):
    from blotter.streaming.runner import state_partitions
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, "500")
    try:
        with state_partitions(spark):
            assert int(spark.conf.get(key)) == spark.sparkContext.defaultParallelism
        assert spark.conf.get(key) == "500"
    finally:
        spark.conf.set(key, old)


def test_mode_a_resumes_with_other_partitions_and_drops_late_rows(spark, code_file, tmp_dir):
    """Second arrival, on the same checkpoint and with another number of shuffle
    partitions: a closed-month row is dropped, open months count on."""
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    row = "{i},{d},0310,True,False,4.0,1.0,1.0,1.0"
    _write(f"{src}/a.csv", [FX.HEADER, row.format(i=1, d="2021-01-10T00:00:00.000Z"),
                            row.format(i=2, d="2021-02-20T00:00:00.000Z")], 1_700_000_000)
    _mode_a(spark, src, code_file, tmp_dir)
    _write(f"{src}/b.csv", [FX.HEADER, row.format(i=30, d="2021-01-30T00:00:00.000Z"),
                            row.format(i=31, d="2021-02-02T00:00:00.000Z"),
                            row.format(i=32, d="2021-03-05T00:00:00.000Z")], 1_700_000_100)
    key, old = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set(key, "5")
        got = {r.id: r["count"] for r in _mode_a(spark, src, code_file, tmp_dir)}
    finally:
        spark.conf.set(key, old)
    assert got == {1: 1, 2: 1, 31: 2, 32: 1}


def test_mode_a_replayed_batch_gives_the_same_rows(spark, incident_dir, code_file, tmp_dir):
    inc, _ = parse_records(keyed_lines(directory_lines(spark, incident_dir)))
    events = enrich(with_event_time(inc), read_code_table(spark, code_file))
    first, second = events.where("id <= 106"), events.where("id > 106")
    each = PerRowImage(f"{tmp_dir}/state", parquet_sink(f"{tmp_dir}/out"), 86400, arrival_col="id")
    each(first, 0)
    each(second, 1)
    once = sorted(map(tuple, spark.read.parquet(f"{tmp_dir}/out").collect()))
    each(second, 1)                                             # a crash after the sink: epoch 1 again
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_dir}/out").collect())) == once


def test_fail_mode_stops_the_stream(spark, code_file, tmp_dir):
    import pytest
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    _write(f"{src}/a.csv", [FX.HEADER] + FX.FILE_1 + ["99,bad-date,0110,True,False,1.0,1,1,1"])
    lines = directory_lines(spark, src, streaming=True)
    inc, _ = parse_records(keyed_lines(lines), on_error="fail")
    with pytest.raises(Exception, match="malformed incident record"):
        run_available_now(inc, f"{tmp_dir}/chk", f"{tmp_dir}/out")


def test_replay_of_files_in_parts_loses_no_row(spark):
    """Files larger than a scan split are replayed as several parts: their lines are in the order of
    their dates, so no part's rows are late for what an earlier part closed."""
    from blotter.plans import queries as Q
    from blotter.plans import streams as S
    d = "/root/testdata/sf0.001"
    small = {"spark.sql.files.maxPartitionBytes": "16k", "spark.sql.files.openCostInBytes": "1k"}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        got = sorted(map(str, S.q_replay_path_order(spark, d).collect()))
    finally:
        for k in small:
            spark.conf.unset(k)
    want = Q.q_month_image_closed(spark, d)
    assert got == sorted(map(str, want.select(S.IMAGE_COLS).collect()))


def test_replayed_files_hold_at_least_a_code_table():
    from blotter.plans.streams import replay_files
    assert replay_files(600_000, 20_000) == 8
    assert replay_files(36_000_000, 1_200_000) == 18
    assert replay_files(216_000_000, 7_200_000) == replay_files(2_160_000_000, 72_000_000) == 30

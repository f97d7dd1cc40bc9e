"""Q1-Q5 end to end: directory replay -> serving table + alert log."""

import pytest

from blotter.config import PipelineConfig
from blotter.plans.job import Outputs, run_to_end, start_job
from blotter.sinks.alerts import kafka_sink_options
from blotter.sources.read_models import read_alert_log, read_serving
from blotter.sources.records import kafka_source_options
from tests import fixtures as FX


@pytest.mark.parametrize("mode,months", [("C", {1, 2, 3}), ("A", {1, 2, 3, 4})])
def test_job_end_to_end(spark, incident_dir, code_file, tmp_dir, mode, months):
    cfg = PipelineConfig(mode=mode, anomaly_threshold=50, lookup_path=code_file,
                         checkpoint_dir=f"{tmp_dir}/chk",
                         source={"kind": "directory", "path": incident_dir, "files_per_trigger": 1})
    out = Outputs(serving_path=f"{tmp_dir}/serving", alert_path=f"{tmp_dir}/alerts",
                  rejects_path=f"{tmp_dir}/rejects")
    run_to_end(start_job(spark, cfg, out, {"availableNow": True}))
    image = {r.month: (r["count"], r.count_arrest, r.count_domestic, r.count_monitored_by_fbi)
             for r in read_serving(spark, out.serving_path).collect()}
    assert image == {m: FX.MONTHLY[m] for m in months}      # mode A also shows the open April
    texts = [r.value for r in read_alert_log(spark, out.alert_path).collect()]
    assert len(texts) == FX.ALERTS and FX.FIRST_ALERT in texts
    assert spark.read.parquet(out.rejects_path).count() == 0


def test_kafka_option_builders():
    src = kafka_source_options("incidents", "broker:9092", "g1", max_offsets_per_trigger=1000)
    assert src["subscribe"] == "incidents" and src["startingOffsets"] == "earliest"
    assert src["groupIdPrefix"] == "g1" and "kafka.group.id" not in src and src["maxOffsetsPerTrigger"] == "1000"
    assert kafka_sink_options("anomalies", "broker:9092") == {
        "topic": "anomalies", "kafka.bootstrap.servers": "broker:9092", "kafka.acks": "all"}


@pytest.mark.parametrize("mode,months", [("C", {1, 2, 3}), ("A", {1, 2, 3, 4})])
def test_batch_job_same_outputs(spark, incident_dir, code_file, tmp_dir, mode, months):
    from blotter.plans.batch import run_batch_job
    cfg = PipelineConfig(mode=mode, lookup_path=code_file)
    run_batch_job(spark, cfg, incident_dir, f"{tmp_dir}/serving", f"{tmp_dir}/alerts")
    image = {r.month: (r["count"], r.count_arrest, r.count_domestic, r.count_monitored_by_fbi)
             for r in read_serving(spark, f"{tmp_dir}/serving").collect()}
    assert image == {m: FX.MONTHLY[m] for m in months}
    texts = [r.value for r in read_alert_log(spark, f"{tmp_dir}/alerts").collect()]
    assert len(texts) == FX.ALERTS and FX.FIRST_ALERT in texts


def test_cli_batch(spark, incident_dir, code_file, tmp_dir):
    from blotter.__main__ import main
    assert main(["--iucr-input-file", code_file, "--input-dir", incident_dir, "--batch",
                 "--serving-path", f"{tmp_dir}/serving", "--alert-path", f"{tmp_dir}/alerts"]) == 0
    assert read_serving(spark, f"{tmp_dir}/serving").count() == 3


def test_kafka_source_without_connector_is_explicit(spark):
    from blotter.sources.records import kafka_records
    try:
        kafka_records(spark, kafka_source_options("t", "localhost:1"), streaming=True)
    except RuntimeError as e:
        assert "connector" in str(e)
    # with the connector present the reader is lazy and nothing is raised here


def test_job_resumes_from_its_checkpoints(spark, code_file, tmp_dir):
    """R2: stop after the first file, restart on the same checkpoints with the
    second file present: same table and alert log as one uninterrupted run."""
    import os
    from tests.conftest import _write
    src = f"{tmp_dir}/incidents"
    os.makedirs(src)
    _write(f"{src}/part-0001.csv", [FX.HEADER] + FX.FILE_1, 1_700_000_000)
    cfg = PipelineConfig(mode="C", lookup_path=code_file, checkpoint_dir=f"{tmp_dir}/chk",
                         source={"kind": "directory", "path": src, "files_per_trigger": 1})
    out = Outputs(serving_path=f"{tmp_dir}/serving", alert_path=f"{tmp_dir}/alerts")
    run_to_end(start_job(spark, cfg, out, {"availableNow": True}))
    first = {r.month for r in read_serving(spark, out.serving_path).collect()}
    assert first == {1}                         # watermark 02-26 03:10: February still open
    _write(f"{src}/part-0002.csv", [FX.HEADER] + FX.FILE_2, 1_700_000_100)
    run_to_end(start_job(spark, cfg, out, {"availableNow": True}))
    image = {r.month: (r["count"], r.count_arrest, r.count_domestic, r.count_monitored_by_fbi)
             for r in read_serving(spark, out.serving_path).collect()}
    assert image == {m: FX.MONTHLY[m] for m in (1, 2, 3)}
    texts = [r.value for r in read_alert_log(spark, out.alert_path).collect()]
    assert len(texts) == FX.ALERTS and len(set(texts)) == FX.ALERTS and FX.FIRST_ALERT in texts


def test_cli_stream_available_now(spark, incident_dir, code_file, tmp_dir):
    from blotter.__main__ import main
    assert main(["--iucr-input-file", code_file, "--input-dir", incident_dir, "--available-now",
                 "--flink-delay", "A", "--flink-anomaly-threshold", "110",
                 "--flink-checkpoint-dir", f"{tmp_dir}/chk",
                 "--serving-path", f"{tmp_dir}/serving", "--alert-path", f"{tmp_dir}/alerts"]) == 0
    assert {r.month for r in read_serving(spark, f"{tmp_dir}/serving").collect()} == {1, 2, 3, 4}
    assert read_alert_log(spark, f"{tmp_dir}/alerts").count() == 0       # threshold 110: none


def test_batch_job_csv_lookup_and_fail_mode(spark, incident_dir, code_file, tmp_dir):
    from blotter.plans.batch import run_batch_job
    from tests.conftest import _write
    cfg = PipelineConfig(mode="C", lookup_path=code_file, lookup_parse="csv")
    run_batch_job(spark, cfg, incident_dir, f"{tmp_dir}/serving", f"{tmp_dir}/alerts")
    assert read_serving(spark, f"{tmp_dir}/serving").count() == 3
    _write(f"{incident_dir}/part-0003.csv", [FX.HEADER, "99,not-a-date,0310,True,False,1.0,1,1,1"],
           1_700_000_200)
    with pytest.raises(Exception, match="malformed incident record"):
        run_batch_job(spark, cfg.with_(on_error="fail"), incident_dir, f"{tmp_dir}/serving2")
    run_batch_job(spark, cfg, incident_dir, f"{tmp_dir}/serving3", rejects_path=f"{tmp_dir}/rej")
    run_batch_job(spark, cfg, incident_dir, f"{tmp_dir}/serving3", f"{tmp_dir}/alerts3", rejects_path=f"{tmp_dir}/rej")
    assert [r.key for r in spark.read.parquet(f"{tmp_dir}/rej").collect()] == ["99"]      # a rerun replaces
    before = read_alert_log(spark, f"{tmp_dir}/alerts3").count()
    run_batch_job(spark, cfg, incident_dir, f"{tmp_dir}/serving3", f"{tmp_dir}/alerts3")
    assert read_alert_log(spark, f"{tmp_dir}/alerts3").count() == before


def test_job_keep_year(spark, incident_dir, code_file, tmp_dir):
    cfg = PipelineConfig(mode="C", keep_year=True, lookup_path=code_file, checkpoint_dir=f"{tmp_dir}/chk",
                         source={"kind": "directory", "path": incident_dir, "files_per_trigger": 1})
    out = Outputs(serving_path=f"{tmp_dir}/serving", alert_path=f"{tmp_dir}/alerts")
    run_to_end(start_job(spark, cfg, out, {"availableNow": True}))
    got = sorted((r.year, r.month, r["count"]) for r in read_serving(spark, out.serving_path, keep_year=True).collect())
    assert got == [(2021, m, FX.MONTHLY[m][0]) for m in (1, 2, 3)]


def test_failing_query_stops_the_job(spark, code_file, tmp_dir):
    """One output fails: the job raises and the other queries are stopped."""
    import os
    from tests.conftest import _write
    src = f"{tmp_dir}/incidents"
    os.makedirs(src)
    _write(f"{src}/part-0001.csv", [FX.HEADER] + FX.FILE_1)
    cfg = PipelineConfig(mode="C", lookup_path=code_file, checkpoint_dir=f"{tmp_dir}/chk",
                         source={"kind": "directory", "path": src, "files_per_trigger": 1})
    blocked = f"{tmp_dir}/blocked"
    _write(blocked, ["a file where the alert folder should be"])
    queries = []
    with pytest.raises(Exception):
        queries = start_job(spark, cfg, Outputs(f"{tmp_dir}/serving", alert_path=blocked), {"processingTime": "1 second"})
        run_to_end(queries)
    assert not any(q.isActive for q in spark.streams.active)


def test_unknown_and_incomplete_flags_are_errors(tmp_dir):
    from blotter.__main__ import main
    with pytest.raises(SystemExit):
        PipelineConfig.from_args(["--anomaly-treshold", "50"])
    with pytest.raises(SystemExit):
        main(["--serving-path", "/s", "--code-table", "/c", "--batch", "--input-topic", "t", "--bootstrap-servers", "b"])
    cfg = PipelineConfig.from_args(["--watermark", "2 days", "--on-error", "fail", "--keep-year", "--salt-buckets", "8"])
    assert (cfg.watermark_seconds, cfg.on_error, cfg.keep_year, cfg.salt_buckets) == (172800, "fail", True, 8)


def test_replay_goes_by_path_not_by_time(spark, tmp_dir):
    import os
    from blotter.__main__ import main
    from blotter.sources.records import directory_lines, replay_in_path_order
    from blotter.streaming.runner import run_available_now
    from tests.conftest import _write
    src = f"{tmp_dir}/in"
    os.makedirs(src)
    for i, name in enumerate(["c.csv", "b.csv", "a.csv"]):          # the newest file comes first by path
        _write(f"{src}/{name}", ["header", f"{name},1"], 1_700_000_000 + 100 * i)
    seen = []
    stream = directory_lines(spark, replay_in_path_order(spark, src, f"{tmp_dir}/staged"), streaming=True)
    run_available_now(stream, f"{tmp_dir}/chk", foreach_batch=lambda df, e: seen.extend(r.value for r in df.collect()))
    assert seen == ["a.csv,1", "b.csv,1", "c.csv,1"]
    _write(f"{src}/d.csv", ["header", "d.csv,1"], 1_600_000_000)
    replay_in_path_order(spark, src, f"{tmp_dir}/staged")               # only the new file is staged
    run_available_now(stream, f"{tmp_dir}/chk", foreach_batch=lambda df, e: seen.extend(r.value for r in df.collect()))
    assert seen == ["a.csv,1", "b.csv,1", "c.csv,1", "d.csv,1"]
    assert main(["publish", "--input-dir", src, "--output-path", f"{tmp_dir}/published"]) == 0
    assert directory_lines(spark, f"{tmp_dir}/published/files/*/*/*").count() == 4


def test_replay_of_large_files_keeps_their_lines_in_order(spark, tmp_dir):
    """Files of many splits and of odd names: parts are met by path, then by place in the file;
    a file of a header alone and empty lines leave nothing out of order."""
    import os
    from blotter.sources.records import directory_lines, replay_in_path_order
    from blotter.streaming.runner import run_available_now
    from tests.conftest import _write
    src, want = f"{tmp_dir}/in", []
    os.makedirs(f"{src}/sub")
    for i, name in enumerate(["a b.csv", "c%d.csv", "e[1]{x}.csv", "sub/é.csv", "z.csv"]):
        lines = [f"{name},{n:05d},\"\"," for n in range(400 if i % 2 else 3)]
        _write(f"{src}/{name}", ["header", *lines], 1_700_000_000 - 100 * i)
        want += lines
    _write(f"{src}/y.csv", ["header"])
    key, open_key = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    old, old_open = spark.conf.get(key), spark.conf.get(open_key)
    seen = []
    try:
        spark.conf.set(key, "2000")
        spark.conf.set(open_key, "1")
        staged = replay_in_path_order(spark, src, f"{tmp_dir}/staged")
    finally:
        spark.conf.set(key, old)
        spark.conf.set(open_key, old_open)
    stream = directory_lines(spark, staged, streaming=True)
    run_available_now(stream, f"{tmp_dir}/chk", foreach_batch=lambda df, e: seen.extend(r.value for r in df.collect()))
    assert seen == want

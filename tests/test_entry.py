"""Driver contract: entry smoke, registry/oracle consistency, config."""

import pytest

import __spark_entry__ as E
from blotter.config import PipelineConfig, interval_seconds


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["district", "month", "primary_description"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 20


@pytest.mark.parametrize("name", [n for n in E.queries() if n in E.oracle_sql()])
def test_queries_match_oracle_at_smoke_scale(spark, name):
    from scripts.check_oracle import check
    r = check(spark, name, "/root/testdata/sf0.001", E.queries(), E.oracle_sql())
    assert r["ok"], r


def test_config_neutral_names():
    cfg = PipelineConfig.from_args(["--mode", "A", "--anomaly-period", "7", "--code-table", "/c",
                                    "--checkpoint-dir", "/k", "--input-topic", "t"])
    assert (cfg.mode, cfg.anomaly_period_days, cfg.lookup_path, cfg.checkpoint_dir,
            cfg.source["topic"]) == ("A", 7, "/c", "/k", "t")


def test_config_from_args_later_wins():
    cfg = PipelineConfig.from_args(["--flink-delay", "C", "--flink-anomaly-threshold", "50",
                                    "--iucr-input-file", "/x", "--flink-delay", "A"])
    assert cfg.emit_every_row and cfg.anomaly_threshold == 50.0 and cfg.lookup_path == "/x"
    assert not PipelineConfig(mode="c").emit_every_row       # anything but "A" means C
    assert interval_seconds("1 day") == 86400 and interval_seconds("30 days") == 30 * 86400


def test_scale_settings():
    from blotter.session import scale_settings
    small = scale_settings(10 * 1024 * 1024)
    assert small["spark.sql.shuffle.partitions"] == "1"
    big = scale_settings(100 * 1024 ** 4)                      # 100 TB
    assert big["spark.sql.shuffle.partitions"] == "409600"     # no cap: 256 MB each
    assert big["spark.sql.files.maxPartitionBytes"] == "256m"
    assert scale_settings(1024 ** 4)["spark.sql.shuffle.partitions"] == "4096"

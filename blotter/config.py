"""Job options (the reference's command-line surface) as one dataclass."""

from __future__ import annotations

import argparse
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class PipelineConfig:
    """Options of the incident pipeline.

    ``mode``: "A" emits the updated monthly aggregate for every incoming row;
    every other value means "C" (one row per month once the month is complete).
    """

    mode: str = "C"
    anomaly_period_days: int = 30
    anomaly_slide_days: int = 1
    anomaly_threshold: float = 60.0
    watermark: str = "1 day"
    lookup_path: str | None = None
    lookup_parse: str = "positional"  # "positional" (naive split) or "csv" (quote aware)
    on_error: str = "reject"  # "reject" (side output) or "fail" (job error, like the reference)
    keep_year: bool = False  # serving key gains the year when True
    checkpoint_dir: str | None = None
    source: dict = field(default_factory=dict)
    sinks: dict = field(default_factory=dict)
    broadcast_max_rows: int = 1_000_000
    broadcast_max_bytes: int = 64 * 1024 * 1024
    salt_buckets: int = 0  # > 1 salts the lookup join beyond the broadcast bound for all codes; 0: hot codes are found and salted
    source_partitions: int = 1  # partitions that must have been seen before there is a watermark (topic sources)

    @property
    def emit_every_row(self) -> bool:
        return self.mode == "A"

    @property
    def watermark_seconds(self) -> int:
        return interval_seconds(self.watermark)

    def with_(self, **kw) -> "PipelineConfig":
        return replace(self, **kw)

    @classmethod
    def from_args(cls, argv: list[str]) -> "PipelineConfig":
        """Parse ``--flag value`` options; later flags win, an unknown flag is an
        error.  Each option of the original job has a neutral name and the
        original name as an alias."""
        return cls.from_namespace(cls.parser().parse_args(argv))

    @classmethod
    def parser(cls) -> argparse.ArgumentParser:
        p = argparse.ArgumentParser(prog="blotter", allow_abbrev=False)
        # The original job's option names (second name of each
        # option), accepted so existing invocations keep working.
        p.add_argument("--input-topic", "--crimes-input-topic", dest="input_topic")
        p.add_argument("--code-table", "--iucr-input-file", dest="code_table")
        p.add_argument("--alert-topic", "--anomaly-output-topic", dest="alert_topic")
        p.add_argument("--bootstrap-servers", dest="bootstrap_servers")
        p.add_argument("--group-id", "--kafka-group-id", dest="group_id")
        p.add_argument("--serving-host", "--cassandra-host", dest="serving_host",
                       help="accepted for old invocations; the serving table is a folder (--serving-path)")
        p.add_argument("--serving-port", "--cassandra-port", dest="serving_port", type=int, default=9042, help="as --serving-host")
        p.add_argument("--mode", "--flink-delay", dest="mode", default="C")
        p.add_argument("--anomaly-period", "--flink-anomaly-period", dest="period", type=int, default=30)
        p.add_argument("--anomaly-threshold", "--flink-anomaly-threshold", dest="threshold",
                       type=float, default=60.0)
        p.add_argument("--checkpoint-dir", "--flink-checkpoint-dir", dest="checkpoint_dir")
        d = cls()
        p.add_argument("--anomaly-slide", dest="slide", type=int, default=d.anomaly_slide_days, help="days")
        p.add_argument("--watermark", default=d.watermark, help="event-time delay, such as '1 day'")
        p.add_argument("--lookup-parse", choices=["positional", "csv"], default=d.lookup_parse)
        p.add_argument("--on-error", choices=["reject", "fail"], default=d.on_error)
        p.add_argument("--keep-year", action="store_true", help="the serving key gains the year")
        p.add_argument("--salt-buckets", type=int, default=d.salt_buckets)
        return p

    @classmethod
    def from_namespace(cls, a: argparse.Namespace) -> "PipelineConfig":
        source = {"topic": a.input_topic, "bootstrap_servers": a.bootstrap_servers, "group_id": a.group_id}
        sinks = {"alert_topic": a.alert_topic, "bootstrap_servers": a.bootstrap_servers,
                 "serving_host": a.serving_host, "serving_port": a.serving_port}
        return cls(mode=a.mode, anomaly_period_days=a.period, anomaly_threshold=a.threshold,
                   anomaly_slide_days=a.slide, watermark=a.watermark, lookup_parse=a.lookup_parse,
                   on_error=a.on_error, keep_year=a.keep_year, salt_buckets=a.salt_buckets,
                   lookup_path=a.code_table, checkpoint_dir=a.checkpoint_dir, source=source, sinks=sinks)


_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def interval_seconds(text: str) -> int:
    """'1 day' / '30 days' / '2 hours' -> seconds."""
    n, unit = text.strip().split()
    unit = unit.lower().rstrip("s")
    return int(float(n) * _UNITS[unit])

"""Command line.

``python -m blotter --code-table FILE (--input-dir DIR | --input-topic T
--bootstrap-servers S) --serving-path PATH [--alert-path PATH | --alert-topic T]
[options]`` runs the job; ``python -m blotter publish --input-dir DIR
(--output-topic T --bootstrap-servers S | --output-path PATH)`` publishes the
lines of a folder's files in path order.  ``--help`` lists the options; the
original job's option names are accepted as aliases (see
``PipelineConfig.parser``), later flags win, unknown flags are errors.
"""

from __future__ import annotations

import argparse
import sys

from blotter.config import PipelineConfig
from blotter.plans.job import Outputs, run_with_restarts, start_job
from blotter.sinks.alerts import kafka_sink_options
from blotter.sources.records import directory_lines, kafka_source_options, publish_lines, replay_in_path_order


def job_parser() -> argparse.ArgumentParser:
    p = PipelineConfig.parser()
    p.add_argument("--input-dir")
    p.add_argument("--serving-path", required=True)
    p.add_argument("--alert-path")
    p.add_argument("--rejects-path")
    p.add_argument("--trigger", default="30 seconds", help="micro-batch interval")
    p.add_argument("--files-per-trigger", type=int, default=1, help="0: all that is there")
    p.add_argument("--max-offsets-per-trigger", type=int)
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--restarts", type=int, default=3, help="restarts after a failure, on the same checkpoint")
    p.add_argument("--restart-delay", type=float, default=10.0, help="seconds before a restart")
    p.add_argument("--source-partitions", type=int, help="partitions of the topic: no window closes before all have been seen")
    p.add_argument("--batch", action="store_true", help="process the files at rest in one batch job")
    return p


def main(argv: list[str]) -> int:
    if argv[:1] == ["publish"]:
        return publish(argv[1:])
    p = job_parser()
    a = p.parse_args(argv)
    cfg = PipelineConfig.from_namespace(a)
    if a.batch and not a.input_dir:
        p.error("--batch reads files at rest: give --input-dir")
    if a.input_dir:
        source = {"kind": "directory", "path": a.input_dir, "files_per_trigger": a.files_per_trigger or None}
    elif not (a.input_topic and a.bootstrap_servers):
        p.error("give --input-dir, or --input-topic with --bootstrap-servers")
    else:
        source = {"kind": "kafka", **kafka_source_options(a.input_topic, a.bootstrap_servers, a.group_id,
                                                          max_offsets_per_trigger=a.max_offsets_per_trigger)}
        if a.source_partitions:
            cfg = cfg.with_(source_partitions=a.source_partitions)
    if not cfg.lookup_path:
        p.error("--code-table is required")
    alert_kafka = None
    if not a.alert_path and a.alert_topic:
        if not a.bootstrap_servers:
            p.error("--alert-topic needs --bootstrap-servers")
        alert_kafka = kafka_sink_options(a.alert_topic, a.bootstrap_servers)
    cfg = cfg.with_(source=source)
    from pyspark.sql import SparkSession
    spark = SparkSession.builder.appName("blotter").getOrCreate()
    if a.batch:
        from blotter.plans.batch import run_batch_job
        from blotter.session import ensure_utc
        ensure_utc(spark)
        run_batch_job(spark, cfg, a.input_dir, a.serving_path, a.alert_path, alert_kafka, a.rejects_path)
        return 0
    out = Outputs(a.serving_path, a.alert_path, alert_kafka, a.rejects_path)
    trigger = {"availableNow": True} if a.available_now else {"processingTime": a.trigger}
    run_with_restarts(lambda: start_job(spark, cfg, out, trigger), a.restarts, a.restart_delay)
    return 0


def publish(argv: list[str]) -> int:
    """S3: publish the lines below a folder, file by file in path order."""
    p = argparse.ArgumentParser(prog="blotter publish", allow_abbrev=False)
    p.add_argument("--input-dir", required=True)
    p.add_argument("--output-topic")
    p.add_argument("--bootstrap-servers")
    p.add_argument("--output-path", help="folder for the file form")
    a = p.parse_args(argv)
    if bool(a.output_topic and a.bootstrap_servers) == bool(a.output_path):
        p.error("give --output-topic with --bootstrap-servers, or --output-path")
    from pyspark.sql import SparkSession
    spark = SparkSession.builder.appName("blotter-publish").getOrCreate()
    if a.output_path:
        replay_in_path_order(spark, a.input_dir, a.output_path)
    else:
        publish_lines(directory_lines(spark, a.input_dir), kafka_sink_options(a.output_topic, a.bootstrap_servers))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

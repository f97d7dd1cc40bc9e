"""Incident record sources (S1, S2, S3 key, S8).

Every source yields the same shape: ``key STRING, value STRING`` (plus an
``arrival`` ordering column when the source has one), in batch or streaming.
"""

from __future__ import annotations

import hashlib
import json
import re
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.files import EMPTY_HOST, data_files, get_text, names, put_text, set_times, uri_of
from blotter.functions.parse import record_key
from blotter.schema import LINE

# One whole line per row: a separator that never occurs and no quote handling,
# so empty fields and literal "" stay exactly as written.
_WHOLE_LINE = {"sep": "\x01", "quote": "", "escape": "", "header": "true",
               "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false", "nullValue": "\x02", "emptyValue": ""}


def directory_lines(spark: SparkSession, path: str, streaming: bool = False,
                    files_per_trigger: int | None = 1) -> DataFrame:
    """Every line of every file below ``path`` except each file's first
    line, as ``value``.  Streaming reads one file per micro-batch by default
    (the replay pace is the trigger interval)."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.schema(LINE).options(**_WHOLE_LINE)
    if streaming and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.csv(path).select(F.coalesce(F.col("value"), F.lit("")).alias("value"))


def replay_in_path_order(spark: SparkSession, path: str, staged: str) -> str:
    """The files below ``path``, in path order, staged below ``staged`` so that a file stream
    over them, which goes by modification time, meets them in path order.

    One job copies the lines of all files that no earlier call staged: each scan split
    becomes a part of its own, named by its file and place in it, so a large file is copied by
    many tasks.  Then the parts get modification times in the order of (file path, place).  A
    file of one split is one part, so ``files_per_trigger=1`` replays file by file; of
    a larger one, part by part.  The list of files is on the driver, as Spark's own is."""
    files = data_files(spark, path)
    calls = names(spark, f"{staged}/done")
    done = {f for call in calls for f in json.loads(get_text(spark, f"{staged}/done/{call}"))["files"]}
    new = [f for f in files if f not in done]
    if new:
        target = f"{staged}/files/{len(calls):06d}"
        literal = [re.sub(r"([{}\[\]*?\\])", r"\\\1", f) for f in new]
        rows = spark.read.schema(LINE).options(**_WHOLE_LINE).csv(literal).select(
            F.coalesce(F.col("value"), F.lit("")).alias("value"), F.monotonically_increasing_id().alias("_at"),
            F.sha1(F.regexp_replace("_metadata.file_path", EMPTY_HOST, "$1:/").cast("binary")).alias("file"),
            F.lpad(F.col("_metadata.file_block_start").cast("string"), 15, "0").alias("start"))
        write_line_files(rows.sortWithinPartitions("file", "start", "_at"), target, "overwrite", by=["file", "start"])
        place = {hashlib.sha1(uri_of(spark, f).encode()).hexdigest(): i for i, f in enumerate(new)}
        parts = sorted((place[re.search(r"/file=([0-9a-f]{40})/", p).group(1)], p) for p in data_files(spark, target))
        earliest = max((json.loads(get_text(spark, f"{staged}/done/{call}"))["next_ms"] for call in calls), default=0)
        following = set_times(spark, [p for _, p in parts], max(earliest, int(time.time() * 1000) - len(parts)))
        put_text(spark, f"{staged}/done/{len(calls):06d}.json", json.dumps({"files": new, "next_ms": following}))
    return f"{staged}/files/*/*/*"


def keyed_lines(lines: DataFrame) -> DataFrame:
    """S3: key = text before the first comma, value = whole line.  Lines with
    no comma get a NULL key (the reference throws on them)."""
    return lines.select(record_key(F.col("value")).alias("key"), F.col("value"))


def keyed_text(lines: DataFrame, sep: str = ":") -> DataFrame:
    """S8: 'key<sep>value' console lines, split at the first separator (taken
    literally).  A line without it keeps its text with a NULL key, so it ends
    in the rejects (the console producer refuses such a line)."""
    v = F.col("value")
    pos = F.instr(v, sep)
    return lines.select(F.when(pos > 0, F.substring_index(v, sep, 1)).alias("key"),
                        F.when(pos > 0, v.substr(pos + F.lit(len(sep)), F.length(v))).otherwise(v)
                        .alias("value"))


def kafka_source_options(topic: str, bootstrap_servers: str, group_id: str | None = None,
                         starting_offsets: str = "earliest",
                         max_offsets_per_trigger: int | None = None) -> dict:
    """Options of the Kafka source.  The resume position comes from the
    query's checkpoint.  ``group_id`` becomes the prefix of a group id of its
    own for every query: queries that share one group would each read only
    part of the topic."""
    o = {"subscribe": topic, "kafka.bootstrap.servers": bootstrap_servers,
         "startingOffsets": starting_offsets, "failOnDataLoss": "true"}
    if group_id:
        o["groupIdPrefix"] = group_id
    if max_offsets_per_trigger:
        o["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return o


def kafka_records(spark: SparkSession, options: dict, streaming: bool = True) -> DataFrame:
    """Kafka topic as (key, value, arrival=(partition, offset))."""
    reader = (spark.readStream if streaming else spark.read).format("kafka").options(**options)
    try:
        df = reader.load()
    except Exception as e:
        if "kafka" in str(e).lower() and "data source" in str(e).lower():
            raise RuntimeError("the Kafka connector (spark-sql-kafka-0-10) is not on the classpath; "
                               "use the directory source or add the connector package") from e
        raise
    return df.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        F.struct("partition", "offset").alias("arrival"))


def incident_records(spark: SparkSession, source: dict, streaming: bool = True) -> DataFrame:
    """Incident records from the configured source.

    ``{"kind": "kafka", ...kafka_source_options}`` or
    ``{"kind": "directory", "path": ..., "files_per_trigger": 1}``; with
    ``"staged": folder`` a streaming directory source replays the files that
    are there now in path order (:func:`replay_in_path_order`).
    """
    kind = source.get("kind", "directory")
    if kind == "kafka":
        opts = {k: v for k, v in source.items() if k != "kind"}
        return kafka_records(spark, opts, streaming)
    if kind == "directory":
        path = source["path"]
        if streaming and source.get("staged"):
            path = replay_in_path_order(spark, path, source["staged"])
        lines = directory_lines(spark, path, streaming, source.get("files_per_trigger", 1))
        return keyed_lines(lines)
    raise ValueError(f"unknown source kind {kind!r}")


def write_line_files(lines: DataFrame, path: str, mode: str = "append", by: list[str] | None = None) -> None:
    """File twin of publishing lines: text files, each starting with a header
    line that the directory source skips (the producer skips line 1); ``by``: columns
    that name their folders."""
    by = by or []
    (lines.select("value", *by).write.mode(mode).partitionBy(*by)
     .option("header", "true").option("sep", "\x01").option("quote", "")
     .option("escapeQuotes", "false").option("quoteAll", "false")
     .csv(path))


def publish_lines(lines: DataFrame, kafka_options: dict | None = None, path: str | None = None) -> None:
    """S3: publish text lines keyed by their first field - to a Kafka topic
    (``kafka_sink_options``) or, as the file twin, to a line folder."""
    if kafka_options is not None:
        keyed_lines(lines).write.format("kafka").options(**kafka_options).save()
    else:
        write_line_files(lines, path)

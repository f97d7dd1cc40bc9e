"""Read models (S6, S7): serving table and alert log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_serving(spark: SparkSession, path: str, where: Column | str | None = None,
                 keep_year: bool = False) -> DataFrame:
    """The newest snapshot of the serving table, optionally filtered.  ``district`` is
    the partition column, so a district predicate prunes whole folders."""
    from blotter.sinks.serving import read_snapshot, serving_schema
    df = read_snapshot(spark, path, serving_schema(keep_year))
    return df.where(where) if where is not None else df


def read_alert_log(spark: SparkSession, path: str | None = None,
                   kafka_options: dict | None = None) -> DataFrame:
    """All alert lines from the beginning, as ``value STRING``."""
    if kafka_options is not None:
        # accepts the sink's options too: topic -> subscribe, producer settings dropped
        opts = {k: v for k, v in kafka_options.items() if k not in ("topic", "kafka.acks")}
        if "topic" in kafka_options:
            opts.setdefault("subscribe", kafka_options["topic"])
        opts.setdefault("startingOffsets", "earliest")
        return (spark.read.format("kafka").options(**opts).load()
                .select(F.col("value").cast("string").alias("value")))
    return spark.read.option("recursiveFileLookup", "true").text(path).select("value")

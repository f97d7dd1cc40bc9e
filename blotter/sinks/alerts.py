"""K2: alert lines (value only, UTF-8) to a topic, or to a text folder."""

from __future__ import annotations

from pyspark.sql import DataFrame


def kafka_sink_options(topic: str, bootstrap_servers: str) -> dict:
    """Producer options: value only, no key; acknowledged by all replicas."""
    return {"topic": topic, "kafka.bootstrap.servers": bootstrap_servers, "kafka.acks": "all"}


def write_alert_log(messages: DataFrame, path: str | None = None,
                    kafka_options: dict | None = None, mode: str = "append") -> None:
    """Batch write of ``value`` lines."""
    out = messages.select("value")
    if kafka_options is not None:
        out.write.format("kafka").options(**kafka_options).save()
    else:
        out.write.mode(mode).text(path)


def alert_stream_writer(messages: DataFrame, checkpoint: str, path: str | None = None,
                        kafka_options: dict | None = None):
    """Streaming writer of ``value`` lines (at-least-once to Kafka; exactly
    once to the file sink)."""
    w = messages.select("value").writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if kafka_options is not None:
        return w.format("kafka").options(**kafka_options)
    return w.format("text").option("path", path)

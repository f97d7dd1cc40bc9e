"""Sinks: upserted serving table and the alert log."""

from blotter.sinks.serving import (create_serving_table, truncate_serving_table, upsert_serving,
                                   serving_batch_writer)
from blotter.sinks.alerts import write_alert_log, alert_stream_writer, kafka_sink_options

__all__ = ["create_serving_table", "truncate_serving_table", "upsert_serving",
           "serving_batch_writer", "write_alert_log", "alert_stream_writer", "kafka_sink_options"]

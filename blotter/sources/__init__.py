"""Sources: incident records (topic or directory replay), code table, read models."""

from blotter.sources.records import (incident_records, directory_lines, kafka_records,
                                     keyed_lines, keyed_text, kafka_source_options, publish_lines,
                                     write_line_files)
from blotter.sources.codes import (CodeTable, code_table_from_lines, load_code_table,
                                   read_code_table)
from blotter.sources.read_models import read_serving, read_alert_log

__all__ = ["incident_records", "directory_lines", "kafka_records", "keyed_lines", "keyed_text",
           "publish_lines", "write_line_files",
           "kafka_source_options", "read_code_table", "code_table_from_lines",
           "load_code_table", "CodeTable",
           "read_serving", "read_alert_log"]

"""blotter: incident analytics on Spark.

Reads keyed CSV incident records (topic or directory), types and cleans them,
enriches them from a code table, keeps a monthly image of counts per
(category, district) and raises alerts when the share of monitored incidents in
a district over a sliding window of days crosses a threshold.

Main entry points::

    from blotter import PipelineConfig, start_job, run_batch_job      # whole job
    from blotter import parse_records, enrich, month_image, sliding_counts, running_counts
"""

from blotter.config import PipelineConfig
from blotter.session import build_session, checkpoint_root, ensure_utc, scale_settings


def __getattr__(name):
    # operators and plans are imported lazily (they pull in pandas/pyarrow)
    table = {
        "parse_records": "blotter.functions.parse",
        "enrich": "blotter.operators.enrich",
        "month_image": "blotter.operators.monthly",
        "closed_months": "blotter.operators.monthly",
        "sliding_counts": "blotter.operators.anomaly",
        "anomaly_results": "blotter.operators.anomaly",
        "alerts": "blotter.operators.anomaly",
        "alert_messages": "blotter.operators.anomaly",
        "running_counts": "blotter.operators.running",
        "start_job": "blotter.plans.job",
        "run_to_end": "blotter.plans.job",
        "Outputs": "blotter.plans.job",
        "run_batch_job": "blotter.plans.batch",
        "image_and_alerts": "blotter.plans.batch",
    }
    if name in table:
        import importlib
        return getattr(importlib.import_module(table[name]), name)
    raise AttributeError(name)


__all__ = ["PipelineConfig", "build_session", "checkpoint_root", "ensure_utc", "scale_settings",
           "parse_records", "enrich", "month_image", "closed_months", "sliding_counts",
           "anomaly_results", "alerts", "alert_messages", "running_counts", "start_job",
           "run_to_end", "Outputs", "run_batch_job", "image_and_alerts"]

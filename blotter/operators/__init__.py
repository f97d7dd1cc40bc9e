"""DataFrame operators of the incident pipeline (batch and streaming)."""

from blotter.operators.enrich import enrich, broadcast_if_bounded
from blotter.operators.monthly import month_image, closed_months, month_start_of
from blotter.operators.running import running_counts
from blotter.operators.anomaly import sliding_counts, anomaly_results, alerts, alert_messages

__all__ = ["enrich", "broadcast_if_bounded", "month_image", "closed_months", "month_start_of",
           "running_counts", "sliding_counts", "anomaly_results", "alerts", "alert_messages"]

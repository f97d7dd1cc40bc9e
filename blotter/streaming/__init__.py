"""Structured Streaming forms of the operators (watermarks, windows, state)."""

from blotter.streaming.windows import (month_image_stream, sliding_counts_stream,
                                       with_watermark)
from blotter.streaming.stateful import PerRowImage
from blotter.streaming.runner import run_available_now
from blotter.streaming.metrics import late_rows_dropped

__all__ = ["month_image_stream", "sliding_counts_stream", "with_watermark",
           "PerRowImage", "run_available_now", "late_rows_dropped"]

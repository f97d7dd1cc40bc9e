"""L1 visibility: rows dropped as late, from streaming query progress."""

from __future__ import annotations

from pyspark.sql.streaming import StreamingQuery


def late_rows_dropped(query: StreamingQuery) -> int:
    """Rows the stateful operators dropped because their window had closed
    (sum of ``numRowsDroppedByWatermark`` over the retained progress)."""
    total = 0
    for p in query.recentProgress:
        for op in p.get("stateOperators", []) if isinstance(p, dict) else p.stateOperators:
            n = op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict) else op.numRowsDroppedByWatermark
            total += int(n or 0)
    return total

"""Result decoration and alert text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the alert text layout of the reference's result record.
ALERT_TEMPLATE = ("CrimeAnomalyResult(start={start}, end={end}, district={district}, count={count}, "
                  "countMonitoredByFbi={monitored}, percentageMonitoredByFbi={percentage})")


def percentage(monitored: Column, count: Column) -> Column:
    """monitored / (double) count * 100.0, in this operation order."""
    return monitored / count.cast("double") * F.lit(100.0)


def local_datetime_text(ts: Column) -> Column:
    """ISO local date-time as printed by a local date-time's toString:
    seconds are omitted when zero, fractions shown only when present."""
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm")
    secs = F.date_format(ts, ":ss")
    frac = F.regexp_replace(F.date_format(ts, ".SSSSSS"), "0+$", "")
    has_frac = F.date_format(ts, "SSSSSS") != F.lit("000000")
    ms_len = F.length(frac) - 1
    frac = F.when(ms_len <= 3, F.rpad(frac, 4, "0")).otherwise(F.rpad(frac, 7, "0"))
    return (F.when(has_frac, F.concat(base, secs, frac))
            .when(F.second(ts) != 0, F.concat(base, secs))
            .otherwise(base))


def alert_text(start: Column, end: Column, district: Column, count: Column,
               monitored_count: Column, pct: Column, template: str = ALERT_TEMPLATE) -> Column:
    """One alert line (P15); numbers print like the JVM's default toString."""
    parts = {
        "start": local_datetime_text(start),
        "end": local_datetime_text(end),
        "district": district.cast("string"),
        "count": count.cast("string"),
        "monitored": monitored_count.cast("string"),
        "percentage": pct.cast("string"),
    }
    out, rest = [], template
    while "{" in rest:
        pre, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        if pre:
            out.append(F.lit(pre))
        out.append(parts[name])
    if rest:
        out.append(F.lit(rest))
    return F.concat(*out)

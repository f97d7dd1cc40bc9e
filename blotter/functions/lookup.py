"""Code-table line parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's code-table format.
HEADER_PREFIX = "IUCR"
MONITORED_MARK = "I"
CSV_SCHEMA = "code STRING, primary_description STRING, secondary_description STRING, index_code STRING"


def pad_code(code: Column) -> Column:
    """One leading '0' only when the code has exactly 3 characters."""
    return F.when(F.length(code) == 3, F.concat(F.lit("0"), code)).otherwise(code)


def monitored(index_code: Column) -> Column:
    """Index code 'I' means monitored (P9); missing means not monitored."""
    return F.coalesce(index_code == F.lit(MONITORED_MARK), F.lit(False))


def parse_code_lines(lines: DataFrame, mode: str = "positional") -> DataFrame:
    """Text lines of the code table -> (code, primary_description,
    secondary_description, monitored_by_fbi, _fields).

    ``positional`` splits on every comma, ignoring quotes, exactly like the
    reference (so a quoted description shifts the index-code field);
    ``csv`` is quote aware.  Header lines (starting with 'IUCR') are dropped.
    """
    body = lines.where(~F.col("value").startswith(HEADER_PREFIX))
    if mode == "csv":
        r = F.from_csv(F.col("value"), CSV_SCHEMA)
        cols = body.select(r.alias("_r"), F.lit(4).alias("_fields"))
        raw = [F.col("_r.code"), F.col("_r.primary_description"),
               F.col("_r.secondary_description"), F.col("_r.index_code")]
    elif mode == "positional":
        cols = body.select(F.split("value", ",").alias("_s"),
                           # fields counted without trailing empty ones (a line
                           # ending in ',' has one field fewer)
                           F.size(F.split(F.regexp_replace("value", ",+$", ""), ",")).alias("_fields"))
        raw = [F.get(F.col("_s"), i) for i in range(4)]
    else:
        raise ValueError(f"unknown lookup parse mode {mode!r}")
    return cols.select(
        pad_code(raw[0]).alias("code"),
        raw[1].alias("primary_description"),
        raw[2].alias("secondary_description"),
        monitored(raw[3]).alias("monitored_by_fbi"),
        F.col("_fields"),
    )

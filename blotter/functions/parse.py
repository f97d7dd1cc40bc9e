"""Incident record parsing: keyed CSV text -> typed incident columns.

All expressions are built-in Spark functions, so parsing stays inside whole
stage codegen and works the same on batch and streaming frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's record format.
DATE_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
BLANK_DISTRICT = '""'
FIELD_DATE, FIELD_CODE, FIELD_ARREST, FIELD_DOMESTIC, FIELD_DISTRICT = 1, 2, 3, 4, 5
MIN_FIELDS = 6

INT_MIN, INT_MAX = -(2 ** 31), 2 ** 31 - 1


def split_fields(value: Column) -> Column:
    """Positional split on ',' with no quoting."""
    return F.split(value.cast("string"), ",")


def field(fields: Column, i: int) -> Column:
    """0-based field, NULL when the row is short (never throws)."""
    return F.get(fields, i)


def record_key(line: Column) -> Column:
    """Key of a published line: the text before the first comma."""
    return F.when(F.instr(line, ",") > 0, F.substring_index(line, ",", 1))


def parse_id(key: Column) -> Column:
    """Incident id from the record key (P2); NULL when not a long."""
    k = key.cast("string")
    # Long.parseLong: optional sign then digits only (no blanks, no fraction)
    return F.when(k.rlike(r"^[+-]?[0-9]+$"), k.try_cast("bigint"))


def parse_date(text: Column) -> Column:
    """Local date-time with literal 'Z' and exactly 3 fraction digits (P3), as UTC.

    Resolved as the JVM's default resolver does: a day up to 31 that the month
    does not have becomes its last day, and 24:00:00.000 the next midnight.
    The 'Z' makes the result independent of the session zone, and its test keeps other
    offsets out, as in the reference.  A well-formed text is cast, which is cheap; only
    where that finds no such day or hour are its parts looked at."""
    well_formed = text.rlike(r"^(?!0000)\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])T"
                             r"(([01]\d|2[0-3]):[0-5]\d:[0-5]\d\.\d{3}|24:00:00\.000)Z$")
    first = F.try_to_timestamp(F.concat(F.substring(text, 1, 8), F.lit("01")), F.lit("yyyy-MM-dd")).cast("date")
    day = F.least(F.substring(text, 9, 2).try_cast("int"), F.dayofmonth(F.last_day(first)))
    late = F.substring(text, 12, 2) == "24"
    time = F.when(late, F.lit("T00:00:00.000Z")).otherwise(F.substring(text, 11, 14))
    moment = F.try_to_timestamp(F.concat(F.substring(text, 1, 8), F.lpad(day.cast("string"), 2, "0"), time),
                                F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSX"))
    resolved = F.when(late, moment + F.expr("INTERVAL 1 DAY")).otherwise(moment)
    return F.when(well_formed, F.coalesce(text.try_cast("timestamp"), resolved))


def parse_flag(text: Column) -> Column:
    """Case-insensitive equality with 'true'; anything else is false."""
    return F.coalesce(F.lower(text) == F.lit("true"), F.lit(False))


def parse_district(text: Column) -> Column:
    """round-half-up of a float text to int (P5): floor(x + 0.5), NaN -> 0, saturating."""
    x = text.try_cast("float").cast("double")
    r = F.floor(x + F.lit(0.5))
    r = (F.when(x.isNull(), F.lit(None)).when(F.isnan(x), F.lit(0))
         .otherwise(F.least(F.greatest(r, F.lit(INT_MIN)), F.lit(INT_MAX))))
    return r.cast("int")


def event_time(ts: Column) -> Column:
    """Event time is epoch seconds: millis are dropped."""
    return F.date_trunc("second", ts)


def blank_district(fields: Column) -> Column:
    """district field is exactly two quote characters (NULL-safe)."""
    return field(fields, FIELD_DISTRICT).eqNullSafe(F.lit(BLANK_DISTRICT))


def _typed_fields(fs: Column, key: Column) -> list[Column]:
    return [
        parse_id(key).alias("id"),
        parse_date(field(fs, FIELD_DATE)).alias("date"),
        field(fs, FIELD_CODE).alias("iucr_code"),
        parse_flag(field(fs, FIELD_ARREST)).alias("arrest"),
        parse_flag(field(fs, FIELD_DOMESTIC)).alias("domestic"),
        parse_district(field(fs, FIELD_DISTRICT)).alias("district"),
        (F.size(fs) >= MIN_FIELDS).alias("_wide"),
    ]


def parse_records(records: DataFrame, on_error: str = "reject",
                  keep_columns: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Keyed CSV records -> (incidents, rejects).

    ``records`` has ``key`` and ``value`` (string or binary).  Rows whose
    district field is ``""`` are dropped (F1) before anything is parsed.  Rows
    that cannot be parsed go to ``rejects`` (``on_error="reject"``) or fail the
    job (``on_error="fail"``, as the reference does).

    Plan shape: the line is split once; the typed record is produced by a
    generator over a 0/1-element array (F1 decides which), so the parse
    expressions are evaluated once per row - a plain filter on parsed columns
    would be pushed below the projection with every parse expression copied
    into it.
    """
    typed, bad = _typed_rows(records, keep_columns)
    out_cols = [*keep_columns, "id", "date", "iucr_code", "arrest", "domestic", "district"]
    if on_error == "fail":
        none = typed.where(F.lit(False)).select(
            F.col("_key").alias("key"), F.col("_value").alias("value"),
            F.lit(None).cast("string").alias("reason"))
        return _checked(typed, bad).select(*out_cols), none
    good = typed.where(~bad).select(*out_cols)
    rejects = typed.where(bad).select(
        F.col("_key").alias("key"), F.col("_value").alias("value"), _reason().alias("reason"))
    return good, rejects


def classified_records(records: DataFrame, on_error: str = "reject", keep_columns: tuple[str, ...] = ()) -> DataFrame:
    """Incidents and rejects of :func:`parse_records` in one table, for a consumer that
    reads its source once: ``reason`` is null for an incident; the record's ``key`` and
    ``value`` are kept for a reject."""
    typed, bad = _typed_rows(records, keep_columns)
    if on_error == "fail":
        typed = _checked(typed, bad)
    reason = F.when(bad, _reason())
    return typed.select(*keep_columns, "id", "date", "iucr_code", "arrest", "domestic", "district", reason.alias("reason"),
                        F.when(bad, F.col("_key")).alias("key"), F.when(bad, F.col("_value")).alias("value"))


def _typed_rows(records: DataFrame, keep_columns: tuple[str, ...]) -> tuple[DataFrame, Column]:
    """Typed fields beside the raw record, and the condition of a malformed one."""
    keep = [F.col(c) for c in keep_columns]
    staged = records.select(*keep, F.col("key").cast("string").alias("_key"),
                            F.col("value").cast("string").alias("_value"),
                            split_fields(F.col("value")).alias("_f"))
    fs = F.col("_f")
    record = F.struct(*_typed_fields(fs, F.col("_key")))
    typed = staged.select(*[F.col(c) for c in keep_columns], "_key", "_value",
                          F.inline(F.when(~blank_district(fs), F.array(record)).otherwise(F.array())))
    return typed, (~F.col("_wide") | F.col("id").isNull() | F.col("date").isNull() | F.col("district").isNull())


def _checked(typed: DataFrame, bad: Column) -> DataFrame:
    # a filter predicate is always evaluated (a checked output column could
    # be pruned away when a consumer does not read it)
    fail = F.raise_error(F.concat(F.lit("malformed incident record: "),
                                  F.coalesce(F.col("_value"), F.lit("<null>"))))
    return typed.where(F.when(bad, fail).otherwise(F.lit(True)))


def _reason() -> Column:
    return (F.when(~F.col("_wide"), F.lit("short row"))
            .when(F.col("id").isNull(), F.lit("bad key"))
            .when(F.col("date").isNull(), F.lit("bad date"))
            .otherwise(F.lit("bad district")))


def with_event_time(incidents: DataFrame, date_col: str = "date", name: str = "ts") -> DataFrame:
    return incidents.withColumn(name, event_time(F.col(date_col)))

"""Stand-in inputs built by Spark from the given tables.

incidents <- lineitem: id = l_orderkey*10 + l_linenumber, date = l_shipdate,
code = l_partkey as text, arrest = (l_returnflag = 'R'), domestic =
(l_linestatus = 'O'), district = l_suppkey % 25.

code table <- part, rendered as code-table text lines
'<p_partkey>,<p_type>,<p_name>,<I|N>' (monitored = p_size <= 25) and parsed by
the normal code-table parser.  Keys of 3 digits are padded on the lookup side
only, so incidents with those codes stay unmatched - the no-match path.

orders stand-in (unique key, for per-row running counts): id = o_orderkey,
date = o_orderdate, category = o_orderstatus, district = o_custkey % 25,
arrest = priority '1-URGENT', domestic = priority '2-HIGH', monitored =
o_totalprice > 200000.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions.parse import DATE_PATTERN
from blotter.sources.codes import CodeTable, verified_code_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same table as a file stream (the path is a one-file glob because a
    file stream source lists a folder or a pattern, not a single file)."""
    schema = table(spark, sf_dir, name).schema
    r = spark.readStream.schema(schema)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.parquet(f"{sf_dir.rstrip('/')}/{name}.parque[t]")


def lineitem_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_as_incidents(table(spark, sf_dir, "lineitem"))


def lineitem_as_incidents(li: DataFrame) -> DataFrame:
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_shipdate").cast("timestamp").alias("date"),
        F.col("l_partkey").cast("string").alias("iucr_code"),
        (F.col("l_returnflag") == "R").alias("arrest"),
        (F.col("l_linestatus") == "O").alias("domestic"),
        F.pmod(F.col("l_suppkey"), F.lit(25)).cast("int").alias("district"),
    )


def lineitem_csv_records(spark: SparkSession, sf_dir: str, varied: bool = True) -> DataFrame:
    """The incidents as published CSV lines (value).  ``varied`` uses several
    text forms: mixed-case booleans, '.5' districts, a blank ("") district on
    line 7, day 31 of the month on line 2, hour 24 on line 4; otherwise the lines parse back to exactly ``lineitem_incidents``."""
    return as_csv_records(table(spark, sf_dir, "lineitem"), varied)


def as_csv_records(li: DataFrame, varied: bool = True) -> DataFrame:
    """:func:`lineitem_csv_records` of the given rows, in their order."""
    d = F.pmod(F.col("l_suppkey"), F.lit(25)).cast("string")
    if not varied:
        line = F.concat_ws(",",
                           (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string"),
                           F.date_format(F.col("l_shipdate"), DATE_PATTERN),
                           F.col("l_partkey").cast("string"),
                           F.when(F.col("l_returnflag") == "R", F.lit("True")).otherwise(F.lit("False")),
                           F.when(F.col("l_linestatus") == "O", F.lit("True")).otherwise(F.lit("False")),
                           F.concat(d, F.lit(".0")), F.lit("1.0"), F.lit("41.8"), F.lit("-87.6"))
        return li.select(line.alias("value"))
    district = (F.when(F.col("l_linenumber") == 7, F.lit('""'))
                .when(F.col("l_linenumber") == 3, F.concat(d, F.lit(".5")))
                .when(F.col("l_linenumber") == 5, F.concat(F.lit("-"), d, F.lit(".5")))
                .otherwise(F.concat(d, F.lit(".0"))))
    arrest = (F.when(F.col("l_returnflag") == "R",
                     F.when(F.col("l_linenumber") % 2 == 0, F.lit("TRUE")).otherwise(F.lit("True")))
              .when(F.col("l_returnflag") == "A", F.lit("yes"))
              .otherwise(F.lit("False")))
    domestic = F.when(F.col("l_linestatus") == "O", F.lit("true")).otherwise(F.lit("F"))
    # ship dates are midnights: day 31 of any month, and the end of the day before
    date = (F.when(F.col("l_linenumber") == 2, F.date_format("l_shipdate", "yyyy-MM-'31T'HH:mm:ss.SSS'Z'"))
            .when(F.col("l_linenumber") == 4, F.date_format("l_shipdate", "yyyy-MM-dd'T24:00:00.000Z'"))
            .otherwise(F.date_format("l_shipdate", DATE_PATTERN)))
    line = F.concat_ws(",",
                       (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string"),
                       date, F.col("l_partkey").cast("string"), arrest, domestic, district,
                       F.lit("1.0"), F.lit("41.8"), F.lit("-87.6"))
    return li.select(line.alias("value"))


def part_code_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    header = spark.range(1).select(
        F.lit("IUCR,PRIMARY DESCRIPTION,SECONDARY DESCRIPTION,INDEX CODE").alias("value"))
    body = p.select(F.concat_ws(",", F.col("p_partkey").cast("string"), F.col("p_type"),
                                F.col("p_name"),
                                F.when(F.col("p_size") <= 25, F.lit("I")).otherwise(F.lit("N")))
                    .alias("value"))
    return header.unionByName(body)


def part_codes(spark: SparkSession, sf_dir: str) -> CodeTable:
    """The verified, measured stand-in code table (one job)."""
    return verified_code_table(part_code_lines(spark, sf_dir), "positional")


def orders_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_as_incidents(table(spark, sf_dir, "orders"))


def orders_as_incidents(o: DataFrame, *more: Column) -> DataFrame:
    return o.select(
        *more,
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").cast("timestamp").alias("date"),
        F.col("o_orderstatus").alias("primary_description"),
        F.pmod(F.col("o_custkey"), F.lit(25)).cast("int").alias("district"),
        (F.col("o_orderpriority") == "1-URGENT").alias("arrest"),
        (F.col("o_orderpriority") == "2-HIGH").alias("domestic"),
        (F.col("o_totalprice") > 200000).alias("monitored_by_fbi"),
    )

"""Code table scan (S4, S5, F3): text lines -> unique lookup rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions.lookup import parse_code_lines


@dataclass
class CodeTable:
    """Parsed, verified code table and its measured size (one job)."""
    df: DataFrame
    rows: int
    bytes: int

    def broadcastable(self, max_rows: int, max_bytes: int) -> bool:
        return self.rows <= max_rows and self.bytes <= max_bytes


def _row_bytes(df: DataFrame):
    return sum(F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns) + F.lit(16)


def verified_code_table(lines: DataFrame, mode: str = "positional") -> CodeTable:
    """Parse code-table lines, check the key is unique and every row has its
    four fields (the reference fails while building its map otherwise), and
    measure rows/bytes - all in one aggregation job."""
    codes = parse_code_lines(lines, mode)
    body = codes.drop("_fields")
    stats = (codes.groupBy("code")
             .agg(F.count("*").alias("n"), F.min("_fields").alias("w"),
                  F.sum(_row_bytes(body)).alias("b"))
             .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.max("n").alias("dup"),
                  F.min("w").alias("short"), F.coalesce(F.sum("b"), F.lit(0)).alias("bytes"))
             .first())
    if (stats["dup"] or 0) > 1 or (stats["short"] is not None and stats["short"] < 4):
        problems = (codes.groupBy("code")
                    .agg(F.count("*").alias("n"), F.min("_fields").alias("w"))
                    .where((F.col("n") > 1) | (F.col("w") < 4)).limit(5).collect())
        detail = ", ".join(f"{r['code']!r} (rows={r['n']}, fields={r['w']})" for r in problems)
        raise ValueError(f"code table has duplicate or short rows: {detail}")
    return CodeTable(body, int(stats["rows"]), int(stats["bytes"]))


def code_table_from_lines(lines: DataFrame, mode: str = "positional",
                          check_unique: bool = True) -> DataFrame:
    """Parsed code table as a DataFrame (verified unless ``check_unique`` is False)."""
    if check_unique:
        return verified_code_table(lines, mode).df
    return parse_code_lines(lines, mode).drop("_fields")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.text(path)
    except AnalysisException as e:  # PATH_NOT_FOUND is raised while analysing
        raise ValueError(f"code table file {path} does not exist") from e


def read_code_table(spark: SparkSession, path: str, mode: str = "positional",
                    check_unique: bool = True) -> DataFrame:
    """S4 + S5: read the code table file; a missing file fails up front."""
    return code_table_from_lines(_lines(spark, path), mode, check_unique)


def snapshot_code_table(spark: SparkSession, codes: CodeTable, path: str) -> CodeTable:
    """The table written to ``path`` once and read from there, so that no micro-batch parses it again."""
    codes.df.write.parquet(path)
    return CodeTable(spark.read.schema(codes.df.schema).parquet(path), codes.rows, codes.bytes)


def load_code_table(spark: SparkSession, path: str, mode: str = "positional") -> CodeTable:
    """S4 + S5 with the size measured for the broadcast decision."""
    return verified_code_table(_lines(spark, path), mode)

"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from blotter.files import remove
from blotter.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 2_000_000


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package (once an application), so that their Python
    workers need no copy of it on a path of their own."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="blotter-"), "blotter.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("blotter", os.path.relpath(full, top)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: cuts
    lineage durably and makes non-repeatable columns (partition ids) data.

    The exchanges of the finished job are garbage then; Spark deletes their files
    when the driver's JVM collects it, which is asked for here, so that a chain
    of staged steps does not keep the shuffle files of all of them."""
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def unstage(spark: SparkSession, *spent: DataFrame) -> None:
    """Remove the files of staged frames that nothing reads any more."""
    for df in spent:
        for folder in {os.path.dirname(f) for f in df.inputFiles()}:
            remove(spark, folder)


def with_columns_replaced(schema: T.StructType, added: list[T.StructField]) -> T.StructType:
    """``schema`` plus ``added``; input columns of an added name are replaced."""
    names = {f.name.lower() for f in added}
    return T.StructType([f for f in schema.fields if f.name.lower() not in names] + added)


def text_slices(texts: list[str], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """[start, end) ranges of ``texts`` holding about ``limit`` characters; one
    longer text is a range of its own."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def sized_slices(sizes: list[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """[start, end) ranges of texts of these sizes, about ``limit`` characters each; a longer text is one of its own."""
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def to_batch(columns: dict[str, object], schema: T.StructType) -> pa.RecordBatch:
    """A record batch of ``columns`` in the order and types of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    target = to_arrow_schema(schema)
    arrays = []
    for f in target:
        v = columns[f.name]
        arrays.append(v.cast(f.type) if isinstance(v, pa.Array | pa.ChunkedArray) else pa.array(v, type=f.type))
    return pa.RecordBatch.from_arrays(arrays, schema=target)


def running_total(spark: SparkSession, df: DataFrame, group: str, order: list[Column],
                  value: str, out: str) -> DataFrame:
    """``df`` plus ``out``: the sum of ``value`` over the rows before this one in
    its ``group`` (``order`` ascending, nulls first).

    A distributed prefix sum: rows are range-partitioned by (group, order), so
    a group that holds most rows spans many tasks; each task sums its own
    rows, and a table with one row per (partition, group) gives what comes
    before.  No task holds a whole group.  Rows equal in group and order are
    interchangeable."""
    keys = [F.col(group), *order]
    tagged = stage(spark, df.repartitionByRange(*keys).withColumn("__pid", F.spark_partition_id()), "range")
    before = Window.partitionBy(group).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    bases = (tagged.groupBy("__pid", group).agg(F.sum(value).alias("__sum"))
             .select(F.col("__pid").alias("__p"), F.col(group).alias("__g"),
                     F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base")))
    inside = Window.partitionBy("__pid", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    run = tagged.withColumn("__run", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = run.join(bases, (F.col("__pid") == F.col("__p")) & F.col(group).eqNullSafe(F.col("__g")))
    return joined.withColumn(out, F.col("__base") + F.col("__run")).drop("__pid", "__p", "__g", "__base", "__run", "__sum")


def ragged_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values[offsets[i]:offsets[i+1]]``; empty ranges give 0."""
    out = np.zeros(len(offsets) - 1)
    full = offsets[1:] > offsets[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, offsets[:-1][full])
    return out

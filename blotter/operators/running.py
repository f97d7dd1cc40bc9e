"""A3: running (per-row) counters within a key, in arrival order.

A window function partitioned by the key would put a hot key - possibly a
third of all rows - into one task.  Instead this is a distributed prefix sum:

1. ``repartitionByRange(P, key.., order..)``: rows are globally ordered, and a
   hot key is cut into several consecutive partitions ("chunks").  The
   partition number is stored as a column and the result is written as
   Parquet below the shared checkpoint folder, so chunk ids are data: every
   later branch (and any recomputation after a lost executor) sees the same
   chunks, and the branch of the totals reads keys and flags only.
2. A window per (chunk, key) gives running counters *within the chunk*; its
   shuffle has as many partitions as there are chunks, which no adaptive rule
   merges, so a task sorts about one chunk.
3. Per (chunk, key) totals come from a JVM partial/final aggregate.  A window
   over those totals (at most P rows per key) gives each chunk the sum of all
   earlier chunks of its key.  Only the first key of a partition can continue
   an earlier chunk, so the offset table has at most P - 1 rows: a proven
   bound, so it is broadcast.
4. Final value = chunk-local running value + chunk offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotter.session import partitions_for, partitions_for_rows, plan_bytes, scratch_path


def running_counts(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   counters: dict[str, str | None], num_partitions: int | None = None,
                   scratch: str | None = None, rows: int | None = None) -> DataFrame:
    """Add one running counter per entry of ``counters`` ({name: boolean
    column, or None for a plain row count}), restarting per ``keys`` and
    accumulating in ``order`` (make it unique for a deterministic result).
    P is ``num_partitions``, or else the largest of the session's shuffle
    partitions and what the bytes and the ``rows`` of ``df`` (counted where not
    given) ask for.  ``scratch``: folder for the
    ranged rows, replaced by the next call that names it (so the result of
    this one must be used up by then); a fresh one by default."""
    spark = df.sparkSession
    keys, order = list(keys), list(order)
    p = num_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), partitions_for(plan_bytes(df) or 0),
                              partitions_for_rows(df.count() if rows is None else rows))
    path = scratch or scratch_path(spark, "running")
    ranged = (df.repartitionByRange(p, *[F.col(c).asc_nulls_first() for c in keys + order])
              .withColumn("_pid", F.spark_partition_id()))
    ranged.write.mode("overwrite" if scratch else "errorifexists").parquet(path)
    chunks = spark.read.schema(ranged.schema).parquet(path)
    ones = {n: F.lit(1) if src is None else F.coalesce(F.col(src), F.lit(False)).cast("bigint") for n, src in counters.items()}

    # chunk totals per (partition, key): JVM partial/final aggregate
    aggs = [F.sum(one).alias(n) for n, one in ones.items()]
    totals = chunks.groupBy("_pid", *keys).agg(*aggs)
    w = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    first_counter = next(iter(counters))
    offsets = (totals.select(F.col("_pid").alias("_o_pid"),
                             *[F.col(k).alias(f"_o_k{i}") for i, k in enumerate(keys)],
                             *[F.sum(n).over(w).alias("_off_" + n) for n in counters])
               .where(F.col("_off_" + first_counter).isNotNull()))   # <= P - 1 rows

    # chunk-local running values: a window holds one key's rows of one chunk
    inside = (Window.partitionBy("_pid", *keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = chunks.repartition(p, "_pid", *keys).select("*", *[F.sum(one).over(inside).alias("_loc_" + n) for n, one in ones.items()])

    cond = [F.col("_pid") == F.col("_o_pid")] + [
        F.col(k).eqNullSafe(F.col(f"_o_k{i}")) for i, k in enumerate(keys)]
    joined = local.join(F.broadcast(offsets), cond, "left")
    return joined.select(
        *df.columns,
        *[(F.col("_loc_" + n) + F.coalesce(F.col("_off_" + n), F.lit(0))).alias(n)
          for n in counters])

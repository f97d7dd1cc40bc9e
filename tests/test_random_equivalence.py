"""Randomised equivalence checks between the batch and streaming forms."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from blotter.operators.anomaly import sliding_counts
from blotter.operators.monthly import closed_months, month_image, watermark_of
from blotter.streaming.runner import run_available_now
from blotter.streaming.windows import month_image_stream, with_watermark

SCHEMA = ("id long, ts timestamp, district int, primary_description string, arrest boolean, "
          "domestic boolean, monitored_by_fbi boolean")


def _rows(seed, n=600):
    rnd = random.Random(seed)
    t0 = dt.datetime(2022, 11, 20)
    out = []
    for i in range(n):
        ts = t0 + dt.timedelta(seconds=rnd.randint(0, 200 * 86400))
        out.append((i, ts, rnd.choice([1, 1, 1, 2, 3]), rnd.choice(["A", "B", "C"]),
                    rnd.random() < 0.3, rnd.random() < 0.4, rnd.random() < 0.5))
    return sorted(out, key=lambda r: r[1])


def test_pane_windows_equal_window_function(spark):
    df = spark.createDataFrame(_rows(1), SCHEMA)
    for period, slide in [(30, 1), (7, 3), (12, 8), (1, 1)]:
        fast = sorted(tuple(r) for r in sliding_counts(df, period, slide).collect())
        w = F.window("ts", f"{period} days", f"{slide} days")
        slow = sorted(tuple(r) for r in df.groupBy(w.alias("w"), "district").agg(
            F.count("*").alias("n"), F.count_if("monitored_by_fbi").alias("m"))
            .select("w.start", "w.end", "district", "n", "m").collect())
        assert fast == slow, (period, slide)


def test_stream_months_equal_batch_under_bounded_disorder(spark, tmp_dir):
    rows = _rows(2)
    rnd = random.Random(3)
    # arrival order: event time plus up to 20 hours of random delay (< the 1-day bound)
    arrival = sorted(rows, key=lambda r: r[1] + dt.timedelta(hours=rnd.uniform(0, 20)))
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    for k in range(0, len(arrival), 100):                         # 6 files, 6 micro-batches
        part = spark.createDataFrame(arrival[k:k + 100], SCHEMA).coalesce(1)
        part.write.parquet(f"{src}/b{k:04d}")
        for f in os.listdir(f"{src}/b{k:04d}"):
            os.utime(f"{src}/b{k:04d}/{f}", (1_700_000_000 + k, 1_700_000_000 + k))
    stream = (spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true")
              .option("maxFilesPerTrigger", 1).parquet(src))
    out = f"{tmp_dir}/out"
    run_available_now(month_image_stream(with_watermark(stream, "ts", "1 day")), f"{tmp_dir}/chk", out)
    got = sorted(tuple(r) for r in spark.read.parquet(out).drop("month_end").collect())
    df = spark.createDataFrame(rows, SCHEMA)
    exp = closed_months(month_image(df), watermark_of(df)).drop("month_end")
    exp = sorted(tuple(r) for r in exp.collect())
    assert len(exp) > 10 and got == exp


def test_sliding_late_row_kept_in_still_open_windows(spark, tmp_dir):
    """A row late for some of its 30 windows is dropped from the closed ones
    only (3 here) and counted in the 27 that are still open."""
    schema = "ts timestamp, district int, monitored_by_fbi boolean"

    def put(name, rows, mtime):
        p = f"{tmp_dir}/src/{name}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(p)
        for f in os.listdir(p):
            os.utime(f"{p}/{f}", (mtime, mtime))

    put("a", [(dt.datetime(2023, 4, 18), 1, True)], 1_700_000_000)
    src = (spark.readStream.schema(schema).option("recursiveFileLookup", "true")
           .option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/src"))
    from blotter.streaming.windows import sliding_counts_stream
    q = sliding_counts_stream(with_watermark(src, "ts", "1 day"), 30, 1)
    for name, rows, mtime in [(None, None, None),
                              ("b", [(dt.datetime(2023, 4, 14), 1, False)], 1_700_000_100),
                              ("c", [(dt.datetime(2023, 6, 30), 1, False)], 1_700_000_200)]:
        if name:
            put(name, rows, mtime)
        run_available_now(q, f"{tmp_dir}/chk", f"{tmp_dir}/out")
    out = spark.read.parquet(f"{tmp_dir}/out").where(F.col("end") < F.lit("2023-06-01").cast("timestamp"))
    late = out.where(F.col("count_monitored_by_fbi") == 0)
    assert late.count() == 1                             # window starting 03-19: late row alone
    assert out.where(F.col("count") == 2).count() == 26  # windows 03-20 .. 04-14: both rows

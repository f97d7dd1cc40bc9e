"""A3: running counters (mode A) as a distributed prefix sum."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from blotter.operators.running import running_counts
from blotter.plans import batch
from blotter.sources.codes import read_code_table
from tests import fixtures as FX
from tests.conftest import records_df


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_sample_rows_running_counts(spark, code_file, parts):
    enr, _ = batch.enriched_incidents(records_df(spark, FX.FILE_1 + FX.FILE_2),
                                      read_code_table(spark, code_file))
    # arrival order = id (the sample ids follow the files); row 108 before row 109
    run = batch.monthly_running(enr, ["id"], num_partitions=parts)
    rows = sorted(run.collect(), key=lambda r: r.id)
    assert [r["count"] for r in rows] == FX.RUNNING
    last = {r.month: (r["count"], r.count_arrest, r.count_domestic, r.count_monitored_by_fbi)
            for r in rows if r.id in FX.LAST_OF_MONTH}
    assert last == FX.MONTHLY


def test_hot_key_split_across_partitions_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        hot = rnd.random() < 0.4                          # one key holds ~40% of rows
        k = "hot" if hot else f"k{rnd.randint(0, 30)}"
        rows.append((i, k, rnd.randint(0, 500), rnd.random() < 0.3, rnd.random() < 0.6))
    pdf = pd.DataFrame(rows, columns=["id", "k", "t", "a", "b"])
    df = spark.createDataFrame(pdf)
    got = running_counts(df, ["k"], ["t", "id"], {"n": None, "na": "a", "nb": "b"}, num_partitions=7)
    got = got.toPandas().sort_values("id").reset_index(drop=True)
    exp = pdf.sort_values(["k", "t", "id"]).copy()
    g = exp.groupby("k")
    exp["n"] = g.cumcount() + 1
    exp["na"] = g["a"].cumsum()
    exp["nb"] = g["b"].cumsum()
    exp = exp.sort_values("id").reset_index(drop=True)
    for c in ["n", "na", "nb"]:
        assert (got[c].astype(int) == exp[c].astype(int)).all(), c


def test_offset_table_is_bounded_by_partitions(spark):
    df = spark.range(5000).select(F.lit("only").alias("k"), F.col("id"), (F.col("id") % 2 == 0).alias("f"))
    out = running_counts(df, ["k"], ["id"], {"n": None, "nf": "f"}, num_partitions=5)
    r = out.agg(F.max("n").alias("n"), F.max("nf").alias("nf")).first()
    assert (r.n, r.nf) == (5000, 2500)


def test_null_keys_and_order_values(spark):
    rnd = random.Random(11)
    rows = [(i, rnd.choice(["a", "b", None]), rnd.choice([None, rnd.randint(0, 50)]), rnd.random() < 0.5)
            for i in range(800)]
    df = spark.createDataFrame(rows, "id long, k string, t int, f boolean")
    got = {r.id: (r.n, r.nf) for r in
           running_counts(df, ["k"], ["t", "id"], {"n": None, "nf": "f"}, num_partitions=5).collect()}
    # brute force: nulls first in the order, NULL is its own key
    exp = {}
    for key in ("a", "b", None):
        grp = sorted([r for r in rows if r[1] == key],
                     key=lambda r: (r[2] is not None, r[2] if r[2] is not None else 0, r[0]))
        n = nf = 0
        for r in grp:
            n += 1
            nf += int(r[3])
            exp[r[0]] = (n, nf)
    assert got == exp


def test_partitions_follow_the_size_of_the_input(spark):
    """The range exchange of a large input has its size's partitions, not the session's."""
    from blotter import session
    df = spark.range(10_000_000).select((F.col("id") % 3).alias("k"), "id")         # an estimate of 160 MB
    assert session.partitions_for(100 * 1024 ** 4) == 409_600
    size = session.plan_bytes(df)
    assert size is not None and size >= 80_000_000
    old = session.PARTITION_BYTES
    small = spark.range(2000).select((F.col("id") % 3).alias("k"), "id")
    import blotter.operators.running as R
    try:
        R.partitions_for = lambda n: session.partitions_for(n, 1000)               # as if 1000 bytes were 256 MB
        out = R.running_counts(small, ["k"], ["id"], {"n": None})
        assert out.count() == 2000
        written = [r[0] for r in spark.read.parquet(out.inputFiles()[0].rsplit("/", 1)[0]).select(F.countDistinct("_pid")).collect()]
        assert written[0] > int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        R.partitions_for = session.partitions_for
        assert session.PARTITION_BYTES == old


def test_chunks_and_their_shuffle_follow_the_rows(spark, tmp_dir):
    """With one shuffle partition, many rows still make several chunks, and no rule merges their tasks."""
    df = spark.range(1_100_000).select("id", (F.col("id") % 2 == 0).alias("a"), F.lit("hot").alias("k"))
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "1")
        got = running_counts(df, ["k"], ["id"], {"n": None, "na": "a"}, scratch=f"{tmp_dir}/chunks")
        chunks = spark.read.parquet(f"{tmp_dir}/chunks").groupBy("_pid").count().collect()
        assert len(chunks) >= 3 and max(c["count"] for c in chunks) < 600_000
        assert got.rdd.getNumPartitions() >= 3
        assert got.where("n <> id + 1 or na <> floor(id / 2) + 1").count() == 0 and got.count() == 1_100_000
    finally:
        spark.conf.set(key, old)

"""State logs, the fan-out job, panes, late counts, lagging partitions, hot codes and restarts."""

import datetime as dt
import os
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.functions.parse import classified_records, parse_records, with_event_time
from blotter.operators.anomaly import sliding_counts
from blotter.operators.enrich import enrich, hot_codes
from blotter.sources.codes import load_code_table
from blotter.sources.records import directory_lines, keyed_lines
from blotter.streaming.fanout import JobBatch, Join
from blotter.streaming.panes import SlidingPanes
from blotter.streaming.statelog import Ledger, Mark, StateLog, last_mark
from blotter.streaming.stateful import MonthImage, PerRowImage, parquet_sink
from tests import fixtures as FX

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("until", T.LongType()), T.StructField("n", T.LongType())])


def _size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names)


def test_log_of_fifty_micro_batches(spark, tmp_dir):
    """The state is that of a dict, replays included; the number of folders is constant, and a
    micro-batch that touches one key writes little beside a state of many keys."""
    log, want, rnd, folders = StateLog(f"{tmp_dir}/log", SCHEMA, ["k", "until"], 4), Counter(), random.Random(5), set()
    many = [(f"key-{i}-{rnd.random()}", 40 if i % 2 else 99, 1) for i in range(5000)]
    for epoch in range(50):
        rows = many if epoch == 0 else [(many[epoch][0], many[epoch][1], epoch)] + ([(None, 99, 2)] if epoch % 3 == 0 else [])
        keep = F.col("until") > epoch
        for _ in range(2 if epoch % 5 == 4 else 1):                   # every fifth is replayed
            held = log.held(spark, epoch, keep)
            if epoch % 7 == 0:
                assert {(r.k, r.until): r.n for r in held.collect()} == {k: n for k, n in want.items() if k[1] > epoch}
            log.append(spark.createDataFrame([r for r in rows if r[1] > epoch], SCHEMA).coalesce(1), epoch)
        for k, until, n in rows:
            if until > epoch:
                want[k, until] += n
        folders.add(len(os.listdir(log.path)))
        if epoch and epoch % 4:
            assert _size(log._delta(epoch)) < 5_000 < _size(log._delta(0)) or epoch >= 8
    assert max(folders) <= 2 + 2 * 4
    assert {(r.k, r.until): r.n for r in log.after(spark, 49).where("until > 49").collect()} == {k: n for k, n in want.items() if k[1] > 49}


def _incidents(spark, rows):
    """(id, time, district[, source]) as enriched incidents of one category."""
    return spark.createDataFrame([(i, "A", d, i % 2 == 0, i % 3 == 0, i % 5 == 0, t, s) for i, t, d, s in rows],
                                 "id long, primary_description string, district int, arrest boolean, domestic boolean, "
                                 "monitored_by_fbi boolean, ts timestamp, source int")


def _day(month, day, year=2021):
    return dt.datetime(year, month, day, 12)


def test_scratch_of_mode_a_is_constant_and_late_rows_are_counted(spark, tmp_dir):
    image = PerRowImage(f"{tmp_dir}/state", parquet_sink(f"{tmp_dir}/out"), 86400, compact_every=2, arrival_col="id")
    folders, late, n = [], 0, 0
    for epoch in range(9):
        rows = [(epoch * 10 + i, _day(epoch + 1, 5 + i), 4, 0) for i in range(3)]
        if epoch >= 2:
            rows += [(epoch * 10 + 8, _day(epoch - 1, 3), 4, 0), (epoch * 10 + 9, _day(1, 1), 4, 0)]     # closed months
            late += 2
        n += 3
        image(_incidents(spark, rows), epoch)
        folders.append(sum(len(names) for d, names, _ in os.walk(image.state)))
        if epoch == 6:
            image(_incidents(spark, rows), epoch)                                # a replay counts once
    assert folders[-1] == folders[-2] == folders[-3] and image.late_rows(spark) == late
    got = spark.read.parquet(f"{tmp_dir}/out").collect()
    assert len(got) == n and sorted(r["count"] for r in got) == sorted([1, 2, 3] * 9)


def test_missing_state_is_an_error(spark, tmp_dir):
    image = MonthImage(f"{tmp_dir}/state", parquet_sink(f"{tmp_dir}/out"), 86400)
    with pytest.raises(RuntimeError, match="no state of micro-batch 2"):
        image(_incidents(spark, [(1, _day(1, 1), 4, 0)]), 3)


def test_watermark_is_the_least_of_the_source_partitions(spark, tmp_dir):
    """Partition 1 lags: its January rows come after partition 0 is in April.  With the largest
    event time of all rows they are late; with the least of the partitions they are not."""
    first = [(1, _day(1, 5), 4, 0), (2, _day(4, 5), 4, 0)]
    second = [(3, _day(1, 20), 4, 1), (4, _day(2, 10), 4, 1)]
    third = [(5, _day(5, 10), 4, 1), (6, _day(5, 9), 4, 0)]
    results = {}
    for name, column in (("all", None), ("least", "source")):
        image = MonthImage(f"{tmp_dir}/{name}", parquet_sink(f"{tmp_dir}/out-{name}"), 86400, partition_col=column, partitions=2)
        for epoch, rows in enumerate((first, second, third)):
            image(_incidents(spark, rows), epoch)
        results[name] = sorted((r.month, r["count"]) for r in spark.read.parquet(f"{tmp_dir}/out-{name}").collect()), image.late_rows(spark)
    assert results == {"all": ([(1, 1), (4, 1)], 2), "least": ([(1, 2), (2, 1), (4, 1)], 0)}
    assert Ledger(f"{tmp_dir}/least", 0).before(spark, 3).watermark_ms == int(dt.datetime(2021, 5, 8, 12, tzinfo=dt.timezone.utc).timestamp() * 1000)


def _pane_rows(spark, rows):
    return spark.createDataFrame([(int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1000), d, m) for t, d, m in rows],
                                 "event_ms long, district int, monitored_by_fbi boolean")


@pytest.mark.parametrize("period, slide", [(30, 1), (7, 3), (2, 5), (6, 4)])
def test_panes_against_brute_force(spark, tmp_dir, period, slide):
    """Random rows, some late, in five micro-batches: each closed window has the rows that
    came before it closed, and is emitted once."""
    rnd, day = random.Random(period), 86_400_000
    panes = SlidingPanes(f"{tmp_dir}/panes", period, slide, compact_every=2)
    before, sent, want_sent, counts = None, [], [], defaultdict(lambda: [0, 0])
    dropped = 0
    for epoch in range(5):
        rows = [(dt.datetime(2021, 1, 1) + dt.timedelta(days=rnd.randint(max(0, 12 * epoch - 20), 12 * epoch + 11), hours=rnd.randint(0, 23)),
                 rnd.choice([1, 2, None]), rnd.random() < .5) for _ in range(40)]
        times = [int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1000) for t, _, _ in rows]
        staged = _pane_rows(spark, rows)
        panes.log.held(spark, epoch, panes.open_panes(before))
        panes.log.append(panes.increments(staged, before), epoch)
        count = staged.select(F.sum(panes.closed_windows(F.floor(F.col("event_ms") / 1000).cast("bigint"), before)).alias("n")).first()["n"]
        late = 0
        for at, (_, d, m) in zip(times, rows):
            start = at // (slide * day) * slide * day
            while start > at - period * day:
                if before is None or start + period * day > before:
                    counts[start, d][0] += 1
                    counts[start, d][1] += m
                else:
                    late += 1
                start -= slide * day
        assert count == late
        dropped += late
        after = max(times + [before or 0])
        closing = {(s, d): c for (s, d), c in counts.items() if s + period * day <= after and (before is None or s + period * day > before)}
        got = panes.closing(panes.log.after(spark, epoch), before, after).select(
            F.unix_millis("start").alias("s"), "district", "count", "count_monitored_by_fbi").collect() if panes.passes_an_end(before, after) else []
        sent += [tuple(r) for r in got]
        want_sent += [(s, d, *c) for (s, d), c in closing.items()]
        before = after
    assert sorted(sent, key=repr) == sorted(want_sent, key=repr) and len(sent) > 20 and dropped > 0


def test_panes_count_a_row_once(spark, tmp_dir):
    panes = SlidingPanes(f"{tmp_dir}/panes", 30, 1)
    plan = panes.increments(_pane_rows(spark, [(dt.datetime(2021, 1, 1), 1, True)]), None)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Generate" not in plan


def _job_rows(spark, incident_dir):
    return classified_records(keyed_lines(directory_lines(spark, incident_dir)))


def test_classified_records_are_both_tables(spark):
    from tests.conftest import records_df
    lines = [*FX.FILE_1, "9,bad,0310,True,False,4.0,1,1,1", "x,2021-01-04T09:30:00.000Z,0310,True,False,4.0,1,1,1", "10,2021",
             '11,2021-01-04T09:30:00.000Z,0310,True,False,"",1,1,1']
    good, rejects = parse_records(records_df(spark, lines))
    both = classified_records(records_df(spark, lines))
    assert sorted(map(tuple, both.where("reason is null").drop("reason", "key", "value").collect())) == sorted(map(tuple, good.collect()))
    assert sorted(map(tuple, both.where("reason is not null").select("key", "value", "reason").collect())) == sorted(map(tuple, rejects.collect()))
    with pytest.raises(Exception, match="malformed incident record"):
        classified_records(records_df(spark, lines), on_error="fail").count()


def test_a_micro_batch_is_executed_once_for_all_outputs(spark, incident_dir, code_file, tmp_dir):
    """Months, alerts and rejects of one micro-batch, and its replay: the source rows are met once
    each time, the code table is joined once, and the replay gives the same."""
    seen, sent = spark.sparkContext.accumulator(0), defaultdict(dict)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = _job_rows(spark, incident_dir)
    batch = rows.mapInArrow(count, rows.schema)
    sink = lambda name: lambda df, epoch: sent[name].__setitem__(epoch, sorted(map(str, df.collect())))
    job = JobBatch(f"{tmp_dir}/job", Join(load_code_table(spark, code_file), 10**6, 10**6), 86400, sink("serving"), sink("alerts"), sink("rejects"))
    job(batch, 0)
    assert seen.value == len(FX.FILE_1 + FX.FILE_2)
    first = {k: dict(v) for k, v in sent.items()}
    assert len(first["serving"][0]) == 3 and len(first["alerts"][0]) == FX.ALERTS and first["rejects"][0] == []
    job(batch, 0)
    assert sent == first and last_mark(spark, f"{tmp_dir}/job") == Mark(0, last_mark(spark, f"{tmp_dir}/job").watermark_ms, 0, 0)


def test_hot_codes_are_dealt_over_partitions(spark):
    """A third of the rows in one code: no partition of the join has twice the median's rows,
    and the result is that of the plain join."""
    rows = spark.range(90_000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 1000 == 1, None).otherwise(
        F.concat(F.lit("c"), (F.col("id") % 4999).cast("string"))).alias("iucr_code"))
    codes = spark.range(4000).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("code"), F.lit("P").alias("primary_description"),
                                     (F.col("id") % 2 == 0).alias("monitored_by_fbi")).unionByName(
        spark.createDataFrame([("hot", "H", True)], "code string, primary_description string, monitored_by_fbi boolean"))
    key, adaptive = "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "16")
        spark.conf.set(adaptive, "false")
        hot = hot_codes(rows, 16)
        assert [r.code for r in hot.collect()] == ["hot"]
        got = enrich(rows, codes, broadcast=False, hot=hot)
        sizes = sorted(r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect())
        assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[8]
        plain = enrich(rows, codes, broadcast=False)
        skewed = sorted(r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect())
        assert skewed[-1] > 4 * skewed[8]
        assert got.columns == plain.columns and got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()
    finally:
        spark.conf.set(key, old)
        spark.conf.set(adaptive, "true")


def test_no_hot_code_and_no_rows(spark):
    none = spark.createDataFrame([], "id long, iucr_code string")
    assert hot_codes(none, 8).count() == 0
    assert hot_codes(spark.range(1000).select(F.col("id").cast("string").alias("iucr_code")), 8).count() == 0


def test_restarts_on_the_same_checkpoint(spark, incident_dir, code_file, tmp_dir):
    """Two failing starts, then the job ends; a job that always fails is given up after its restarts."""
    from blotter.config import PipelineConfig
    from blotter.plans.job import Outputs, run_with_restarts, start_job
    from blotter.sources.read_models import read_serving
    cfg = PipelineConfig(lookup_path=code_file, checkpoint_dir=f"{tmp_dir}/chk", source={"kind": "directory", "path": incident_dir, "files_per_trigger": 1})
    out, waits, starts = Outputs(f"{tmp_dir}/serving"), [], []

    def start():
        starts.append(1)
        if len(starts) < 3:
            raise RuntimeError("lost")
        return start_job(spark, cfg, out, {"availableNow": True})
    assert run_with_restarts(start, 3, 10, waits.append) == 2 and waits == [10, 10]
    assert {r.month for r in read_serving(spark, out.serving_path).collect()} == {1, 2, 3}
    with pytest.raises(RuntimeError, match="always"):
        run_with_restarts(lambda: (_ for _ in ()).throw(RuntimeError("always")), 3, 10, waits.append)
    assert len(waits) == 5


def test_streamed_panes_equal_batch_windows(spark, incident_dir, code_file, tmp_dir):
    inc, _ = parse_records(keyed_lines(directory_lines(spark, incident_dir)))
    events = enrich(with_event_time(inc), load_code_table(spark, code_file))
    panes = SlidingPanes(f"{tmp_dir}/panes", 30, 1)
    staged = events.select(F.unix_millis("ts").alias("event_ms"), "district", "monitored_by_fbi")
    panes.log.held(spark, 0)
    panes.log.append(panes.increments(staged, None), 0)
    got = panes.closing(panes.log.after(spark, 0), None, 4 * 10**12)
    assert got.exceptAll(sliding_counts(events)).isEmpty() and sliding_counts(events).exceptAll(got).isEmpty()


def test_job_in_mode_a_sizes_its_shuffles_by_rows(spark, code_file, tmp_dir):
    """A session with one shuffle partition (a native query's cap): the job's join, counters and
    upsert get partitions for the rows of the micro-batch, and the setting comes back."""
    n, seen = 1_100_000, {}
    batch = spark.range(n).select(
        "id", F.lit("2020-01-05 00:00:00").cast("timestamp").alias("date"), (F.col("id") % 1000).cast("string").alias("iucr_code"),
        F.lit(True).alias("arrest"), F.lit(False).alias("domestic"), (F.col("id") % 5).cast("int").alias("district"),
        F.lit(None).cast("string").alias("reason"), F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("value"))

    def serving(df, epoch):
        seen.update(parts=df.rdd.getNumPartitions(), setting=int(spark.conf.get("spark.sql.shuffle.partitions")),
                    largest=df.groupBy("district").agg(F.max("count").alias("m")).agg(F.sum("m")).first()[0])

    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "1")
        JobBatch(f"{tmp_dir}/job", Join(load_code_table(spark, code_file), 0, 0), 86400, serving, every_row=True)(batch, 0)
        assert seen["parts"] >= 3 and seen["setting"] >= 3 and seen["largest"] <= n
        assert spark.conf.get(key) == "1"
    finally:
        spark.conf.set(key, old)

"""Serving table upsert and reads."""

import datetime as dt

from pyspark.sql import functions as F

from blotter.sinks.serving import create_serving_table, truncate_serving_table, upsert_serving
from blotter.sources.read_models import read_serving

COLS = "district int, month int, primary_description string, count long, count_arrest long, " \
       "count_domestic long, count_monitored_by_fbi long, month_end timestamp"


def _rows(spark, rows):
    return spark.createDataFrame(rows, COLS)


def test_year_collision_newest_wins(spark, tmp_dir):
    path = f"{tmp_dir}/serving"
    upsert_serving(_rows(spark, [(1, 1, "HOMICIDE", 4, 3, 1, 2, dt.datetime(2022, 2, 1)),
                                 (2, 5, "THEFT", 1, 0, 0, 0, dt.datetime(2022, 6, 1))]), path, "month_end")
    upsert_serving(_rows(spark, [(1, 1, "HOMICIDE", 9, 9, 9, 9, dt.datetime(2023, 2, 1))]), path, "month_end")
    got = sorted(tuple(r) for r in read_serving(spark, path).collect())
    assert got == [(1, 1, "HOMICIDE", 9, 9, 9, 9), (2, 5, "THEFT", 1, 0, 0, 0)]


def test_last_emission_within_batch_and_replay_idempotent(spark, tmp_dir):
    path = f"{tmp_dir}/serving"
    batch = _rows(spark, [(1, 4, "HOMICIDE", 1, 0, 0, 0, dt.datetime(2023, 4, 9)),
                          (1, 4, "HOMICIDE", 2, 0, 0, 1, dt.datetime(2023, 4, 10))])
    upsert_serving(batch, path, "month_end")
    upsert_serving(batch, path, "month_end")
    got = [tuple(r) for r in read_serving(spark, path).collect()]
    assert got == [(1, 4, "HOMICIDE", 2, 0, 0, 1)]


def test_keep_year_adds_year_to_key(spark, tmp_dir):
    path = f"{tmp_dir}/serving"
    rows = _rows(spark, [(1, 1, "HOMICIDE", 4, 3, 1, 2, dt.datetime(2022, 2, 1)),
                         (1, 1, "HOMICIDE", 9, 9, 9, 9, dt.datetime(2023, 2, 1))])
    rows = rows.withColumn("year", F.year(F.col("month_end") - F.expr("INTERVAL 1 DAY")))
    upsert_serving(rows, path, "month_end", keep_year=True)
    got = sorted((r.year, r["count"]) for r in read_serving(spark, path, keep_year=True).collect())
    assert got == [(2022, 4), (2023, 9)]


def test_create_truncate_and_filtered_read(spark, tmp_dir):
    path = create_serving_table(spark, f"{tmp_dir}/serving")
    assert read_serving(spark, path).count() == 0
    upsert_serving(_rows(spark, [(d, 1, "X", 1, 0, 0, 0, dt.datetime(2023, 2, 1)) for d in range(5)]),
                   path, "month_end")
    q = read_serving(spark, path, F.col("district") == 3)
    assert [r.district for r in q.collect()] == [3]
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "district" in plan
    truncate_serving_table(spark, path)
    assert read_serving(spark, path).count() == 0


def _table(spark, path):
    return sorted((tuple(r) for r in read_serving(spark, path).collect()), key=repr)


def test_null_districts_are_rows_like_others(spark, tmp_dir):
    """A district without a value keeps its rows when another upsert touches it, or does not."""
    path, month = f"{tmp_dir}/serving", dt.datetime(2023, 2, 1)
    upsert_serving(_rows(spark, [(None, 1, "A", 1, 0, 0, 0, month), (4, 1, "A", 1, 0, 0, 0, month)]), path, "month_end")
    upsert_serving(_rows(spark, [(None, 2, "B", 2, 0, 0, 0, month), (None, 1, None, 5, 0, 0, 0, month)]), path, "month_end")
    upsert_serving(_rows(spark, [(4, 1, "A", 7, 0, 0, 0, month), (None, 1, None, 6, 0, 0, 0, month)]), path, "month_end")
    assert _table(spark, path) == sorted([(None, 1, "A", 1, 0, 0, 0), (None, 2, "B", 2, 0, 0, 0), (None, 1, None, 6, 0, 0, 0),
                                          (4, 1, "A", 7, 0, 0, 0)], key=repr)


def test_a_reader_between_any_two_steps_sees_a_whole_table(spark, tmp_dir, monkeypatch):
    """Read before and after every file operation and every write of an upsert: the old
    table or the new one, never anything between; a reader that resolved its snapshot
    before an upsert still reads it afterwards."""
    from blotter.sinks import serving as S
    path, month = f"{tmp_dir}/serving", dt.datetime(2023, 2, 1)
    upsert_serving(_rows(spark, [(d, m, "A", 1, 0, 0, 0, month) for d in (1, 2, None) for m in (1, 2)]), path, "month_end")
    old, early, seen = _table(spark, path), read_serving(spark, path), []

    def watched(f):
        def step(*a, **k):
            seen.append(_table(spark, path))
            out = f(*a, **k)
            seen.append(_table(spark, path))
            return out
        return step
    for name in ("put_text", "remove", "_publish"):
        monkeypatch.setattr(S, name, watched(getattr(S, name)))
    from pyspark.sql.readwriter import DataFrameWriter
    monkeypatch.setattr(DataFrameWriter, "parquet", watched(DataFrameWriter.parquet))
    upsert_serving(_rows(spark, [(d, 1, "A", 9, 0, 0, 0, month) for d in (1, None)]), path, "month_end")
    monkeypatch.undo()
    new = _table(spark, path)
    assert new != old and len(seen) >= 8
    assert all(t in (old, new) for t in seen) and old in seen and new in seen
    assert sorted(map(tuple, early.collect()), key=repr) == old


def test_a_crash_before_the_pointer_leaves_the_table_and_a_replay_finishes(spark, tmp_dir, monkeypatch):
    import pytest
    from blotter.sinks import serving as S
    path, month = f"{tmp_dir}/serving", dt.datetime(2023, 2, 1)
    upsert_serving(_rows(spark, [(1, 1, "A", 1, 0, 0, 0, month), (1, 2, "A", 5, 0, 0, 0, month)]), path, "month_end")
    before = _table(spark, path)
    batch = _rows(spark, [(1, 1, "A", 2, 0, 0, 0, month)])
    with monkeypatch.context() as m:
        m.setattr(S, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            upsert_serving(batch, path, "month_end", staging=f"{tmp_dir}/staging", epoch_id=7)
    assert _table(spark, path) == before
    for _ in range(2):                                                      # the replay, and one more
        upsert_serving(batch, path, "month_end", staging=f"{tmp_dir}/staging", epoch_id=7)
        assert _table(spark, path) == [(1, 1, "A", 2, 0, 0, 0), (1, 2, "A", 5, 0, 0, 0)]


def test_an_older_micro_batch_is_not_applied_again(spark, tmp_dir):
    path, month = f"{tmp_dir}/serving", dt.datetime(2023, 2, 1)
    for epoch, n in ((7, 1), (9, 3), (7, 1)):
        upsert_serving(_rows(spark, [(1, 1, "A", n, 0, 0, 0, month)]), path, "month_end", staging=f"{tmp_dir}/staging", epoch_id=epoch)
    assert [r["count"] for r in read_serving(spark, path).collect()] == [3]
    upsert_serving(_rows(spark, []), path, "month_end", staging=f"{tmp_dir}/staging", epoch_id=10)          # empty batch: no-op
    assert [r["count"] for r in read_serving(spark, path).collect()] == [3]


def test_old_versions_are_removed_and_untouched_districts_are_not_rewritten(spark, tmp_dir):
    import os
    from blotter.sinks.serving import RETAIN, snapshot
    path, month = f"{tmp_dir}/serving", dt.datetime(2023, 2, 1)
    upsert_serving(_rows(spark, [(d, 1, "A", 1, 0, 0, 0, month) for d in (1, 2)]), path, "month_end")
    first = snapshot(spark, path).districts[2]
    for n in range(12):
        upsert_serving(_rows(spark, [(1, 1, "A", n, 0, 0, 0, month)]), path, "month_end")
    assert snapshot(spark, path).districts[2] == first                      # district 2's folder is still the first one
    assert len(os.listdir(f"{path}/_data")) <= RETAIN + 1
    assert len([n for n in os.listdir(f"{path}/_pointer") if n.endswith(".json")]) == RETAIN
    assert _table(spark, path) == [(1, 1, "A", 11, 0, 0, 0), (2, 1, "A", 1, 0, 0, 0)]


def test_read_serving_with_year(spark, tmp_dir):
    path = f"{tmp_dir}/serving"
    rows = _rows(spark, [(1, 1, "A", 4, 0, 0, 0, dt.datetime(2022, 2, 1)),
                         (1, 1, "A", 9, 0, 0, 0, dt.datetime(2023, 2, 1))])
    upsert_serving(rows.withColumn("year", F.year(F.col("month_end") - F.expr("INTERVAL 1 DAY"))),
                   path, "month_end", keep_year=True)
    got = sorted((r.year, r["count"]) for r in read_serving(spark, path, keep_year=True).collect())
    assert got == [(2022, 4), (2023, 9)]


def test_a_truncated_table_knows_no_earlier_run(spark, tmp_dir):
    """Another checkpoint, or the same one after a truncation, is not taken for a replay."""
    path = f"{tmp_dir}/serving"
    old = _rows(spark, [(1, 1, "A", 1, 0, 0, 0, dt.datetime(2023, 2, 1)), (1, 2, "B", 1, 0, 0, 0, dt.datetime(2023, 3, 1))])
    new = _rows(spark, [(1, 1, "A", 7, 0, 0, 0, dt.datetime(2023, 2, 1))])
    upsert_serving(old, path, "month_end", epoch_id=1, staging=f"{tmp_dir}/run1")
    truncate_serving_table(spark, path)
    upsert_serving(new, path, "month_end", epoch_id=1, staging=f"{tmp_dir}/run2")
    assert [tuple(r) for r in read_serving(spark, path).collect()] == [(1, 1, "A", 7, 0, 0, 0)]
    truncate_serving_table(spark, path)
    upsert_serving(new, path, "month_end", epoch_id=1, staging=f"{tmp_dir}/run1")     # run 1's folder, new generation
    assert [tuple(r) for r in read_serving(spark, path).collect()] == [(1, 1, "A", 7, 0, 0, 0)]


def test_upsert_runs_its_input_once(spark, tmp_dir):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = _rows(spark, [(d, 1, "X", 1, 0, 0, 0, dt.datetime(2023, 2, 1)) for d in range(40)])
    upsert_serving(rows.mapInArrow(count, rows.schema), f"{tmp_dir}/serving", "month_end", epoch_id=0, staging=f"{tmp_dir}/staging")
    assert seen.value == 40

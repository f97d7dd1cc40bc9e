"""Code table and enrichment."""

import os

import pytest

from blotter.operators.enrich import broadcast_if_bounded, enrich
from blotter.sources.codes import code_table_from_lines, read_code_table
from tests import fixtures as FX
from tests.conftest import records_df


def _lines(spark, lines):
    return spark.createDataFrame([(v,) for v in lines], "value string")


def test_small_table_padded(spark, code_file):
    codes = {r.code: (r.primary_description, r.monitored_by_fbi)
             for r in read_code_table(spark, code_file).collect()}
    assert codes == {"0310": ("PIRACY", True), "0311": ("PIRACY", False),
                     "0320": ("SMUGGLING", True), "0321": ("SMUGGLING", False)}


def test_pad_only_three_characters(spark):
    rows = code_table_from_lines(_lines(spark, ["12,A,x,I", "123,B,x,I", "031A,C,x,N", "12345,D,x,I"])).collect()
    assert sorted(r.code for r in rows) == ["0123", "031A", "12", "12345"]


def test_quoted_row_positional_versus_csv(spark):
    lines = _lines(spark, [FX.CODE_HEADER] + FX.CODES_QUOTED)
    pos = {r.code: r.monitored_by_fbi for r in code_table_from_lines(lines, "positional").collect()}
    csv = {r.code: r.monitored_by_fbi for r in code_table_from_lines(lines, "csv").collect()}
    assert pos == {"0910": True, "0915": False}
    assert csv == {"0910": True, "0915": True}


def test_duplicate_code_fails(spark):
    with pytest.raises(ValueError, match="duplicate"):
        code_table_from_lines(_lines(spark, ["110,A,x,I", "0110,B,y,N"]))


def test_missing_file_fails(spark, tmp_dir):
    with pytest.raises(ValueError, match="does not exist"):
        read_code_table(spark, os.path.join(tmp_dir, "nope.csv"))


def test_trailing_space_kept(spark):
    rows = code_table_from_lines(_lines(spark, ["5000,OTHER OFFENSE ,x,N"])).collect()
    assert rows[0].primary_description == "OTHER OFFENSE "


def test_enrich_defaults_and_unpadded_incident_code(spark, code_file):
    from blotter.functions.parse import parse_records
    lines = ["1,2023-05-01T00:00:00.000Z,0310,true,false,1.0,1,1,1",
             "2,2023-05-01T00:00:00.000Z,9999,true,false,1.0,1,1,1",
             "3,2023-05-01T00:00:00.000Z,310,true,false,1.0,1,1,1"]
    inc, _ = parse_records(records_df(spark, lines))
    out = {r.id: (r.primary_description, r.monitored_by_fbi)
           for r in enrich(inc, read_code_table(spark, code_file)).collect()}
    assert out == {1: ("PIRACY", True), 2: ("", False), 3: ("", False)}


@pytest.mark.parametrize("kw", [{"broadcast": False}, {"broadcast": False, "salt_buckets": 3},
                                {"max_rows": 2}])
def test_enrich_shuffle_paths_same_result(spark, code_file, kw):
    from blotter.functions.parse import parse_records
    inc, _ = parse_records(records_df(spark, FX.FILE_1 + FX.FILE_2))
    codes = read_code_table(spark, code_file)
    a = sorted(tuple(r) for r in enrich(inc, codes).collect())
    b = sorted(tuple(r) for r in enrich(inc, codes, **kw).collect())
    assert a == b


def test_broadcast_check_is_bounded(spark):
    df = spark.range(100).selectExpr("cast(id as string) as code")
    assert broadcast_if_bounded(df, max_rows=1000)[1] is True
    assert broadcast_if_bounded(df, max_rows=10)[1] is False
    assert broadcast_if_bounded(df, max_rows=1000, max_bytes=100)[1] is False


def test_trailing_empty_index_field_is_short(spark):
    with pytest.raises(ValueError, match="short|duplicate"):
        code_table_from_lines(_lines(spark, ["110,PIRACY,X,"]))


def test_hot_code_split_by_aqe_on_shuffle_path(spark):
    """A third of all incidents share one code; beyond the broadcast bound the
    left join's hot partition is split at run time (AQE skew join)."""
    from pyspark.sql import functions as F
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        inc = spark.range(60000).select(
            "id", F.when(F.col("id") % 3 == 0, F.lit("0110"))
            .otherwise((F.col("id") % 500).cast("string")).alias("iucr_code"))
        codes = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("code"),
                                         F.lit("X").alias("primary_description"),
                                         (F.col("id") % 2 == 0).alias("monitored_by_fbi"))
        out = enrich(inc, codes, broadcast=False)
        rows = out.collect()
        assert len(rows) == 60000
        assert sum(r.primary_description == "X" for r in rows) == 20000   # only "0110" matches
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_shuffle_path_never_broadcasts_at_default_thresholds(spark, code_file):
    from blotter.functions.parse import parse_records
    inc, _ = parse_records(records_df(spark, FX.FILE_1 + FX.FILE_2))
    codes = read_code_table(spark, code_file)
    for salt in (0, 4):
        df = enrich(inc, codes, broadcast=False, salt_buckets=salt)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    with pytest.raises(ValueError, match="too large to broadcast"):
        enrich(inc, codes, broadcast=True, max_rows=2)

"""Record parsing and the reject path."""

import datetime as dt

import pytest

from blotter.functions.parse import parse_records
from tests import fixtures as FX
from tests.conftest import records_df

GOOD = "{id},2023-05-01T00:00:00.000Z,0110,True,False,{d},1.0,1.0,1.0"


def _parse(spark, lines, on_error="reject"):
    good, rej = parse_records(records_df(spark, lines), on_error)
    return [r.asDict() for r in good.orderBy("id").collect()], [r.asDict() for r in rej.collect()]


def test_sample_rows_typed(spark):
    good, rej = _parse(spark, FX.FILE_1 + FX.FILE_2)
    assert rej == [] and len(good) == 14
    r = good[0]
    assert r == {"id": 101, "date": dt.datetime(2021, 1, 4, 9, 30), "iucr_code": "0310",
                 "arrest": True, "domestic": False, "district": 4}
    assert [g["id"] for g in good] == list(range(101, 115))


def test_blank_district_dropped_empty_rejected(spark):
    good, rej = _parse(spark, [GOOD.format(id=20, d='""'), GOOD.format(id=21, d="")])
    assert good == []
    assert [(r["key"], r["reason"]) for r in rej] == [("21", "bad district")]


def test_short_row_and_no_millis_rejected(spark):
    good, rej = _parse(spark, ["21,2023-05-01T00:00:00.000Z,0110",
                               "22,2023-05-01T00:00:00Z,0110,True,False,1.0,1,1,1",
                               "23,2023-05-01T00:00:00.000+01:00,0110,True,False,1.0,1,1,1"])
    assert good == []
    assert sorted((r["key"], r["reason"]) for r in rej) == [
        ("21", "short row"), ("22", "bad date"), ("23", "bad date")]


def test_boolean_forms(spark):
    forms = ["TRUE", "true", "t", "1", ""]
    lines = [f"{i},2023-05-01T00:00:00.000Z,0110,{f},{f},1.0,1,1,1" for i, f in enumerate(forms, 30)]
    good, _ = _parse(spark, lines)
    assert [g["arrest"] for g in good] == [True, True, False, False, False]
    assert [g["domestic"] for g in good] == [True, True, False, False, False]


def test_half_districts_round_half_up(spark):
    ds = ["0.5", "1.5", "2.5", "-1.5", "-0.5", "3.49", " 7.0 ", "NaN",
          "1.5d", "1.0f", "0x1p3", "1e40", "-1e40"]
    good, _ = _parse(spark, [GOOD.format(id=40 + i, d=d) for i, d in enumerate(ds)])
    assert [g["district"] for g in good] == [1, 2, 3, -1, 0, 3, 7, 0,
                                            2, 1, 8, 2 ** 31 - 1, -(2 ** 31)]


def test_key_is_record_key_not_csv_field(spark):
    from blotter.sources.records import keyed_text
    df = spark.createDataFrame([("99:5,2023-05-01T00:00:00.000Z,0110,true,false,2.0,1,1,1",)], "value string")
    good, _ = parse_records(keyed_text(df))
    assert [r.id for r in good.collect()] == [99]


def test_on_error_fail_raises(spark):
    good, _ = parse_records(records_df(spark, ["21,2023-05-01T00:00:00.000Z,0110"]), "fail")
    with pytest.raises(Exception, match="malformed incident record"):
        good.collect()


def test_millis_kept_in_date_dropped_in_event_time(spark):
    from blotter.functions.parse import with_event_time
    good, _ = parse_records(records_df(spark, ["1,2023-01-31T23:59:59.999Z,0110,true,false,1.0,1,1,1"]))
    r = with_event_time(good).first()
    assert r.date == dt.datetime(2023, 1, 31, 23, 59, 59, 999000)
    assert r.ts == dt.datetime(2023, 1, 31, 23, 59, 59)


def test_on_error_fail_raises_even_when_id_is_not_read(spark):
    good, _ = parse_records(records_df(spark, ["21,2023-05-01T00:00:00.000Z,0110,true,false,,1,1,1"]), "fail")
    with pytest.raises(Exception, match="malformed incident record"):
        good.groupBy("district").count().collect()


def test_keyed_text_literal_separator(spark):
    from blotter.sources.records import keyed_text
    df = spark.createDataFrame([("7|a|b",), ("no-separator",), ("|x",)], "value string")
    got = [tuple(r) for r in keyed_text(df, "|").collect()]
    assert got == [("7", "a|b"), (None, "no-separator"), ("", "x")]


def test_dates_resolve_as_on_the_jvm(spark):
    """A day up to 31 the month lacks is its last; 24:00:00.000 the next midnight."""
    texts = {1: "2023-02-30T10:00:00.000Z", 2: "2024-02-30T10:00:00.000Z", 3: "2023-04-31T23:59:59.999Z",
             4: "2023-12-31T24:00:00.000Z", 5: "2023-02-31T24:00:00.000Z", 6: "2023-02-32T10:00:00.000Z",
             7: "2023-13-01T10:00:00.000Z", 8: "2023-01-01T24:00:01.000Z", 9: "0000-01-01T10:00:00.000Z", 10: "2023-02-00T10:00:00.000Z"}
    good, rej = _parse(spark, [f"{i},{t},0310,True,False,1.0,1,1,1" for i, t in texts.items()])
    assert {r["id"]: r["date"] for r in good} == {
        1: dt.datetime(2023, 2, 28, 10), 2: dt.datetime(2024, 2, 29, 10), 3: dt.datetime(2023, 4, 30, 23, 59, 59, 999000),
        4: dt.datetime(2024, 1, 1), 5: dt.datetime(2023, 3, 1)}
    assert sorted(int(r["key"]) for r in rej) == [6, 7, 8, 9, 10]

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelcast.operators.locations import build_location_map, location_key, map_county_to_branch
from panelcast.sources.calendar import calendar_features, forecast_yearweeks, latest_closed_yearweek, yearweek_of


def test_iso_yearweek_edges(spark):
    df = spark.createDataFrame([(dt.date(2020, 12, 31),), (dt.date(2021, 1, 3),), (dt.date(2024, 12, 30),)], "d date")
    got = [r[0] for r in df.select(yearweek_of("d")).collect()]
    assert got == [202053, 202053, 202501]


def _weekdate(spark, start=dt.date(2020, 12, 1), days=120):
    rows = [(start + dt.timedelta(days=i),) for i in range(days)]
    return spark.createDataFrame(rows, "date date").select("date", yearweek_of("date").alias("yearweek"))


def test_week_lookups(spark):
    wd = _weekdate(spark)
    assert latest_closed_yearweek(wd, dt.date(2021, 1, 11)) == 202101
    assert forecast_yearweeks(wd, 3, dt.date(2021, 1, 11)) == [202102, 202103, 202104]
    with pytest.raises(RuntimeError):
        forecast_yearweeks(wd, 30, dt.date(2021, 3, 1))


def test_calendar_rollup(spark):
    wd = _weekdate(spark)
    hol = spark.createDataFrame(
        [(dt.date(2021, 2, 11), "農曆除夕", "是", "除夕"), (dt.date(2021, 2, 12), "春節", "是", "初一"),
         (dt.date(2021, 3, 1), "例假", "否", None)],
        "DATE date, NAME string, LEAVE string, LY string",
    )
    rows = {r.yearweek: r for r in calendar_features(hol, wd).collect()}
    w = rows[202106]
    assert (w.cnt, w.voc, w.eve, w.ev_period, w.di_period, w.covid) == (5, 1, 2, 0, 1, 1)
    m = rows[202109]
    assert (m.cnt, m.ev_period, m.di_period) == (7, 1, 0)


def test_location_key(spark):
    df = spark.createDataFrame([(" 臺北市 ",), ("新　北 市",), (None,)], "c string")
    assert [r[0] for r in df.select(location_key("c")).collect()] == ["台北市", "新北市", ""]


def test_location_map_conflict_and_unmapped(spark):
    dim = spark.createDataFrame([("臺北縣", "新北市", "北區"), ("台北市", "台北市", "北區"), ("桃園縣", "桃園市", None)],
                                "old_name string, new_name string, branch_t string")
    m = build_location_map(dim)
    assert {r.county_key: r.branch_t for r in m.collect()} == {"台北縣": "北區", "新北市": "北區", "台北市": "北區"}
    panel = spark.createDataFrame([("臺北 縣", 1.0), ("桃園市", 2.0)], "county string, count double")
    with pytest.raises(RuntimeError, match="桃園市"):
        map_county_to_branch(panel, m)
    bad = spark.createDataFrame([("甲", "甲", "北區"), ("甲", "甲", "南區")], "old_name string, new_name string, branch_t string")
    with pytest.raises(RuntimeError, match="more than one branch"):
        build_location_map(bad)

"""Week calendar: ISO yearweeks, week lookups and the weekly calendar rollup (SRC-4/5/7/8/9, AGG-1, SCA-3..7, SCA-12).

The calendar is owned by a ``dim_weekdate(date, yearweek)`` table, never by
integer arithmetic on yearweeks. The few week lists needed as parameters
(forecast horizon, training cut) are bounded by the horizon, not by data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast import config as C
from panelcast.sources.scans import pick_col


def yearweek_of(col) -> F.Column:
    """ISO year * 100 + ISO week, as INT."""
    c = F.col(col) if isinstance(col, str) else col
    d = F.to_date(c)
    return (F.extract(F.lit("YEAROFWEEK"), d) * 100 + F.weekofyear(d)).cast("int")


def normalize_weekdate(weekdate: DataFrame) -> DataFrame:
    d = pick_col(weekdate, ["date", "DATE"])
    yw = pick_col(weekdate, ["yearweek", "YEARWEEK"])
    return weekdate.select(F.to_date(F.col(d)).alias("date"), F.col(yw).cast("int").alias("yearweek"))


def week_range(weekdate: DataFrame, start_date, end_date=None) -> DataFrame:
    """SRC-7: distinct yearweeks of a date range, ordered."""
    end_date = end_date or start_date
    wd = normalize_weekdate(weekdate)
    return (
        wd.filter(F.col("date").between(F.lit(start_date).cast("date"), F.lit(end_date).cast("date")))
        .select("yearweek").distinct().orderBy("yearweek")
    )


def latest_closed_week_df(weekdate: DataFrame, base_date: dt.date) -> DataFrame:
    """SRC-8 as a one-row frame: the yearweek of (base date - 7 days)."""
    return week_range(weekdate, base_date - dt.timedelta(days=7)).limit(1).withColumnRenamed("yearweek", "train_cut_week")


def latest_closed_yearweek(weekdate: DataFrame, base_date: dt.date) -> int:
    rows = latest_closed_week_df(weekdate, base_date).collect()
    if not rows:
        raise RuntimeError("the calendar holds no week that has ended")
    return int(rows[0][0])


def forecast_weeks_df(weekdate: DataFrame, forecast_period: int, base_date: dt.date) -> DataFrame:
    """SRC-9 as a frame: the first N yearweeks from the base date, with lead_week 1..N."""
    end = base_date + dt.timedelta(days=7 * (forecast_period - 1))
    wk = week_range(weekdate, base_date, end).limit(forecast_period)
    return wk.select("yearweek")


def forecast_yearweeks(weekdate: DataFrame, forecast_period: int, base_date: dt.date) -> list[int]:
    """SRC-9: N forecast weeks (a list bounded by the horizon); fewer than N is an error."""
    weeks = [int(r[0]) for r in forecast_weeks_df(weekdate, forecast_period, base_date).collect()]
    if len(weeks) < forecast_period:
        raise RuntimeError(f"the calendar holds {len(weeks)} of the {forecast_period} weeks to forecast")
    return weeks[:forecast_period]


def covid_flag(yearweek_col="yearweek", covid_years=C.COVID_YEARS) -> F.Column:
    """SCA-7 / COL-13: 1 when the yearweek's year lies in the COVID range."""
    year = (F.col(yearweek_col) / 100).cast("int")
    return year.between(covid_years[0], covid_years[1]).cast("int")


def calendar_features(holiday: DataFrame, weekdate: DataFrame, covid_years=C.COVID_YEARS) -> DataFrame:
    """AGG-1: weekly calendar rollup from the holiday table joined to the week-date table.

    Only weeks with at least one holiday row exist (the join drops the rest).
    """
    hd = pick_col(holiday, ["DATE", "date"])
    name = pick_col(holiday, ["NAME", "name"])
    leave = pick_col(holiday, ["LEAVE", "leave"])
    ly = pick_col(holiday, ["LY", "ly"])
    h = holiday.select(
        F.to_date(F.col(hd)).alias("holiday_date"),
        F.col(name).alias("NAME"), F.col(leave).alias("LEAVE"), F.col(ly).alias("LY"),
    )
    wd = normalize_weekdate(weekdate)
    # the week-date table has one row per day: a bounded dimension, broadcast it
    j = h.join(F.broadcast(wd), h.holiday_date == wd.date, "inner")
    flags = j.select(
        "yearweek",
        F.month("date").isin(*C.EV_SEASON_MONTHS).cast("int").alias("ev_period"),
        F.coalesce(F.col("NAME").isin(*C.FESTIVAL_NAMES).cast("int"), F.lit(0)).alias("di_period"),
        (F.col("yearweek") % 100).isin(*C.SCHOOL_HOLIDAY_WEEKS).cast("int").alias("voc"),
        F.coalesce((F.col("LEAVE") == C.LEAVE_YES).cast("int"), F.lit(0)).alias("leave"),
        F.coalesce(F.col("LY").isin(*C.LUNAR_EVE_NAMES).cast("int"), F.lit(0)).alias("eve"),
    )
    out = flags.groupBy("yearweek").agg(
        F.sum("leave").alias("leave_sum"),
        F.max("voc").alias("voc"),
        F.sum("eve").alias("eve"),
        F.max("ev_period").alias("ev_period"),
        F.max("di_period").alias("di_period"),
    )
    return out.select(
        "yearweek",
        (F.lit(7) - F.col("leave_sum")).cast("int").alias("cnt"),
        F.col("voc").cast("int").alias("voc"),
        F.col("eve").cast("int").alias("eve"),
        F.col("ev_period").cast("int").alias("ev_period"),
        F.col("di_period").cast("int").alias("di_period"),
        covid_flag("yearweek", covid_years).alias("covid"),
    )

"""Canonical inputs derived from the driver's star-schema tables (see FIXTURES.md section 2).

Each builder has a DuckDB twin in ``SQL_VIEWS`` so the oracle queries in
``__spark_entry__`` start from the same derivation. The week function is
``yw(d)``: Spark ``extract(YEAROFWEEK)*100 + weekofyear``, DuckDB
``isoyear*100 + week``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.sources.calendar import yearweek_of

# Fixture parameters (FIXTURES.md): the EV role is return flag 'A', the COVID
# years are 1998-1999, the base date is fixed, and three nations of one region
# play the offshore counties.
TEST_EV_DISEASE = "A"
TEST_COVID_YEARS = (1998, 1999)
TEST_BASE_DATE = dt.date(2001, 7, 2)
TEST_OFFSHORE = ("NATION_2", "NATION_7", "NATION_12")
SRC_A = "src_a"
SRC_B = "src_b"


class Tables:
    """Lazy access to the driver's parquet tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def panel_a(t: Tables, start_week: int | None = None, end_week: int | None = None) -> DataFrame:
    """Weekly line counts per (ship week, supplier nation, return flag).

    Week bounds become bounds on the ship date, which reach the scan (whole ISO weeks, so counts stay whole).
    """
    lines = t.lineitem
    if start_week is not None:
        lines = lines.where(F.col("l_shipdate") >= F.lit(monday(start_week)))
    if end_week is not None:
        lines = lines.where(F.col("l_shipdate") < F.lit(monday(end_week) + dt.timedelta(days=7)))
    li = lines.select(
        "l_suppkey", yearweek_of("l_shipdate").alias("yearweek"), F.col("l_returnflag").alias("disease")
    )
    # nation has 25 rows by definition: broadcast; how the supplier map is joined is left to Spark's measured sizes
    sup = t.supplier.select("s_suppkey", "s_nationkey").join(
        F.broadcast(t.nation.select("n_nationkey", "n_name")), F.col("s_nationkey") == F.col("n_nationkey")
    )
    j = li.join(sup, F.col("l_suppkey") == F.col("s_suppkey"))
    return j.groupBy("yearweek", F.col("n_name").alias("county"), "disease").agg(
        F.count(F.lit(1)).cast("double").alias("count")
    )


def monday(yearweek: int) -> dt.date:
    """First day of an ISO week; a week beyond its year's last one runs on into the next year."""
    return dt.date.fromisocalendar(yearweek // 100, 1, 1) + dt.timedelta(weeks=yearweek % 100 - 1)


def orders_weekly(t: Tables) -> DataFrame:
    """Orders and their total price per (order week, customer nation, priority): the one pass over orders and customers
    that both the order panel and the weather table come from."""
    o = t.orders.select("o_custkey", "o_totalprice", yearweek_of("o_orderdate").alias("yearweek"), "o_orderpriority")
    j = o.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    return j.groupBy("yearweek", "c_nationkey", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders"), F.count("o_totalprice").alias("priced"), F.sum("o_totalprice").alias("price")
    )


def panel_b(t: Tables, weekly: DataFrame | None = None) -> DataFrame:
    """Weekly order counts per (order week, customer region, order priority)."""
    weekly = orders_weekly(t) if weekly is None else weekly
    geo = (
        t.nation.select("n_nationkey", "n_regionkey")
        .join(t.region.select("r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    j = weekly.join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("yearweek", F.col("r_name").alias("county"), F.col("o_orderpriority").alias("disease")).agg(
        F.sum("orders").cast("double").alias("count")
    )


def panel_a_wide(t: Tables) -> DataFrame:
    """panel_a with one conditional count column per return flag."""
    p = panel_a(t)
    return p.groupBy("yearweek", "county").agg(
        F.sum(F.when(F.col("disease") == "A", F.col("count"))).alias("ev_total"),
        F.sum(F.when(F.col("disease") == "N", F.col("count"))).alias("ili_total"),
        F.sum(F.when(F.col("disease") == "R", F.col("count"))).alias("di_total"),
    )


def source_total(t: Tables) -> DataFrame:
    return source_total_from(panel_a(t))


def source_total_from(panel: DataFrame) -> DataFrame:
    return panel.groupBy(F.lit(SRC_A).alias("data_source"), "yearweek", "county").agg(F.sum("count").alias("total_count"))


def weather_weekly(t: Tables, weekly: DataFrame | None = None) -> DataFrame:
    weekly = orders_weekly(t) if weekly is None else weekly
    j = weekly.join(F.broadcast(t.nation.select("n_nationkey", "n_name")), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("yearweek", F.col("n_name").alias("city")).agg(
        F.try_divide(F.sum("price"), F.sum("priced")).alias("airtemperature_avg"), F.sum("orders").alias("rain_days")
    )


def dim_weekdate(t: Tables) -> DataFrame:
    """Every date from January 1 of the first data year to December 31 of the year after the last."""
    # min/max straight on the scanned columns, so parquet footers can answer them
    per_table = t.orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")).unionByName(
        t.lineitem.agg(F.min("l_shipdate").alias("lo"), F.max("l_shipdate").alias("hi")))
    bounds = per_table.agg(F.to_date(F.min("lo")).alias("lo"), F.to_date(F.max("hi")).alias("hi"))
    start = F.make_date(F.year("lo"), F.lit(1), F.lit(1))
    end = F.make_date(F.year("hi") + 1, F.lit(12), F.lit(31))
    days = bounds.select(F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY"))).alias("date"))
    return days.select("date", yearweek_of("date").alias("yearweek"))


def dim_holiday(t: Tables, weekdate: DataFrame | None = None) -> DataFrame:
    """Holiday rows by month-day rule over the week-date dates."""
    d = dim_weekdate(t) if weekdate is None else weekdate
    md = F.date_format("date", "MM-dd")
    lunar = F.create_map(
        F.lit("01-28"), F.lit("小年夜"), F.lit("01-29"), F.lit("除夕"), F.lit("01-30"), F.lit("初一"),
        F.lit("01-31"), F.lit("初二"), F.lit("02-01"), F.lit("初三"), F.lit("02-02"), F.lit("初四"),
        F.lit("02-03"), F.lit("初五"),
    )
    ly = lunar[md]
    name = (
        F.when(ly.isNotNull(), F.lit("春節"))
        .when(md == "10-10", F.lit("國慶日"))
        .when(F.dayofmonth("date") == 1, F.lit("例假"))
    )
    leave = F.when(ly.isNotNull() | (md == "10-10"), F.lit("是")).otherwise(F.lit("否"))
    return d.select(F.col("date").alias("DATE"), name.alias("NAME"), leave.alias("LEAVE"), ly.alias("LY")).filter(
        F.col("NAME").isNotNull()
    )


def dim_location(t: Tables) -> DataFrame:
    """Place -> region for every place that occurs in the source panel (nation x region, limited to the data)."""
    shipped = t.lineitem.where(F.col("l_shipdate").isNotNull()).select("l_suppkey").distinct()
    nations = t.supplier.join(shipped, F.col("s_suppkey") == F.col("l_suppkey"), "left_semi").select("s_nationkey").distinct()
    places = t.nation.join(nations, F.col("n_nationkey") == F.col("s_nationkey"), "left_semi").select("n_name")
    geo = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")
    return places.join(F.broadcast(geo), "n_name").select(
        F.col("n_name").alias("old_name"), F.col("n_name").alias("new_name"), F.col("r_name").alias("branch_t")
    )


def dim_location_raw(t: Tables) -> DataFrame:
    """``dim_location`` as it may come: names with blanks around and inside, both spellings of one sign, repeated rows,
    blank names, rows without a branch, and a second branch for the places whose name ends in 1."""
    d = dim_location(t).withColumnsRenamed({"old_name": "n", "branch_t": "b"}).select("n", "b")
    none = F.lit(None).cast("string")

    def row(old, new, branch):
        return F.struct(old.alias("old_name"), new.alias("new_name"), branch.alias("branch_t"))

    n, b = F.col("n"), F.col("b")
    rows = F.array(
        row(n, n, b),
        row(F.concat(F.lit("  "), n, F.lit("　")), n, F.concat(b, F.lit(" "))),
        row(F.concat(F.lit("臺 "), n), F.concat(F.lit("台"), n), b),
        row(F.lit(" "), n, b),
        row(n, none, F.when(n.endswith("1"), F.lit("SECOND"))),
    )
    return d.select(F.inline(rows))


# ---------------------------------------------------------------------------
# DuckDB twins of the builders above (used by oracle_sql()).
# ---------------------------------------------------------------------------
def _yw(d: str) -> str:
    return f"CAST(isoyear({d}) * 100 + week({d}) AS INTEGER)"


SQL_VIEWS = {
    "panel_a": f"""
        SELECT {_yw('l.l_shipdate')} AS yearweek, n.n_name AS county, l.l_returnflag AS disease,
               CAST(count(*) AS DOUBLE) AS count
        FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
        GROUP BY 1, 2, 3""",
    "panel_b": f"""
        SELECT {_yw('o.o_orderdate')} AS yearweek, r.r_name AS county, o.o_orderpriority AS disease,
               CAST(count(*) AS DOUBLE) AS count
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
             JOIN region r ON n.n_regionkey = r.r_regionkey
        GROUP BY 1, 2, 3""",
    "panel_a_wide": """
        SELECT yearweek, county,
               sum(CASE WHEN disease = 'A' THEN count END) AS ev_total,
               sum(CASE WHEN disease = 'N' THEN count END) AS ili_total,
               sum(CASE WHEN disease = 'R' THEN count END) AS di_total
        FROM panel_a GROUP BY 1, 2""",
    "source_total": f"""
        SELECT '{SRC_A}' AS data_source, yearweek, county, sum(count) AS total_count FROM panel_a GROUP BY 2, 3""",
    "weather_weekly": f"""
        SELECT {_yw('o.o_orderdate')} AS yearweek, n.n_name AS city, avg(o.o_totalprice) AS airtemperature_avg,
               count(*) AS rain_days
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
        GROUP BY 1, 2""",
    "dim_weekdate": f"""
        SELECT CAST(g.d AS DATE) AS date, {_yw('g.d')} AS yearweek
        FROM (SELECT min(d) AS lo, max(d) AS hi FROM (
                SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem)) b,
             LATERAL (SELECT unnest(generate_series(make_date(year(b.lo), 1, 1)::TIMESTAMP,
                                                    make_date(year(b.hi) + 1, 12, 31)::TIMESTAMP,
                                                    INTERVAL 1 DAY)) AS d) g""",
    "dim_holiday": """
        SELECT date AS "DATE",
               CASE WHEN ly IS NOT NULL THEN '春節' WHEN md = '10-10' THEN '國慶日' WHEN day(date) = 1 THEN '例假' END AS "NAME",
               CASE WHEN ly IS NOT NULL OR md = '10-10' THEN '是' ELSE '否' END AS "LEAVE",
               ly AS "LY"
        FROM (SELECT date, strftime(date, '%m-%d') AS md,
                     CASE strftime(date, '%m-%d') WHEN '01-28' THEN '小年夜' WHEN '01-29' THEN '除夕'
                          WHEN '01-30' THEN '初一' WHEN '01-31' THEN '初二' WHEN '02-01' THEN '初三'
                          WHEN '02-02' THEN '初四' WHEN '02-03' THEN '初五' END AS ly
              FROM dim_weekdate)
        WHERE ly IS NOT NULL OR md = '10-10' OR day(date) = 1""",
    "dim_location": """
        SELECT n.n_name AS old_name, n.n_name AS new_name, r.r_name AS branch_t
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
        WHERE n.n_name IN (SELECT county FROM panel_a)""",
    "dim_location_raw": """
        SELECT old_name, new_name, branch_t FROM dim_location
        UNION ALL SELECT '  ' || old_name || '　', old_name, branch_t || ' ' FROM dim_location
        UNION ALL SELECT '臺 ' || old_name, '台' || old_name, branch_t FROM dim_location
        UNION ALL SELECT ' ', old_name, branch_t FROM dim_location
        UNION ALL SELECT old_name, NULL, CASE WHEN ends_with(old_name, '1') THEN 'SECOND' END FROM dim_location""",
    "dim_calendar": f"""
        SELECT yearweek, CAST(7 - sum(lv) AS INTEGER) AS cnt, CAST(max(voc) AS INTEGER) AS voc,
               CAST(sum(eve) AS INTEGER) AS eve, CAST(max(evp) AS INTEGER) AS ev_period,
               CAST(max(dip) AS INTEGER) AS di_period,
               CAST(yearweek // 100 BETWEEN {TEST_COVID_YEARS[0]} AND {TEST_COVID_YEARS[1]} AS INTEGER) AS covid
        FROM (SELECT w.yearweek,
                     CASE WHEN h."LEAVE" = '是' THEN 1 ELSE 0 END AS lv,
                     CASE WHEN w.yearweek % 100 IN (5,6,7,28,29,30,31,32,33,34,35,36) THEN 1 ELSE 0 END AS voc,
                     CASE WHEN h."LY" IN ('小年夜','除夕','初一','初二','初三','初四','初五') THEN 1 ELSE 0 END AS eve,
                     CASE WHEN month(w.date) IN (3,4,5,6,9) THEN 1 ELSE 0 END AS evp,
                     CASE WHEN h."NAME" IN ('農曆除夕','春節','中秋節','國慶日') THEN 1 ELSE 0 END AS dip
              FROM dim_holiday h JOIN dim_weekdate w ON h."DATE" = w.date)
        GROUP BY yearweek""",
}

_VIEW_DEPS = {
    "panel_a_wide": ["panel_a"],
    "source_total": ["panel_a"],
    "dim_holiday": ["dim_weekdate"],
    "dim_calendar": ["dim_holiday", "dim_weekdate"],
    "dim_location": ["panel_a"],
    "dim_location_raw": ["dim_location"],
}


def with_views(body: str, *names: str, extra: dict | None = None) -> str:
    """``WITH <needed views>, <extra CTEs> <body>`` for DuckDB."""
    order: list[str] = []

    def add(n):
        for d in _VIEW_DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = [f"{n} AS ({SQL_VIEWS[n]})" for n in order]
    for k, v in (extra or {}).items():
        ctes.append(f"{k} AS ({v})")
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body

"""Registered queries (``queries()``) and their DuckDB twins (``oracle_sql()``).

Each query reads the driver's tables through ``panelcast.sources.testviews``
and runs one operator (or a composite) of the inventory over the whole data.
Floating outputs are rounded to 6 digits on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast import config as C
from panelcast.operators import evaluate as EV
from panelcast.operators import features as FE
from panelcast.operators import oof as OO
from panelcast.operators import splits as SP
from panelcast.plans import sqlgen as Q
from panelcast.sources import scans as SC
from panelcast.sources import testviews as TV

QUERIES: dict = {}
ORACLES: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[
        (F.round(F.col(f.name), digits) + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        else F.col(f.name)
        for f in df.schema.fields
    ])


# ---------------------------------------------------------------------------
# shared fixture builders
# ---------------------------------------------------------------------------
_MEMO: dict = {}


def materialized(spark: SparkSession, sf: str, name: str, build):
    """Build once per session and scale factor; DataFrames are checkpointed into ``spark.checkpoint.dir``.

    The weekly panels are small aggregates of the large fact tables: they are
    computed once, written to the shared checkpoint folder (lineage cut, so a
    lost executor does not trigger a rescan of the facts) and reused by every
    downstream query.
    """
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _MEMO:
        value = build()
        if isinstance(value, DataFrame):
            from panelcast.session import reliable_checkpoint

            value = reliable_checkpoint(value)
        _MEMO[key] = value
    return _MEMO[key]


def target_a(spark: SparkSession, sf: str) -> DataFrame:
    def build():
        t = TV.Tables(spark, sf)
        return SC.normalize_target(SC.load_source_weekly(TV.panel_a(t), TV.SRC_A, check_empty=False))

    return materialized(spark, sf, "target_a", build)


def orders_weekly(spark: SparkSession, sf: str) -> DataFrame:
    return materialized(spark, sf, "orders_weekly", lambda: TV.orders_weekly(TV.Tables(spark, sf)))


def target_b(spark: SparkSession, sf: str) -> DataFrame:
    def build():
        t = TV.Tables(spark, sf)
        return SC.normalize_target(SC.load_source_weekly(TV.panel_b(t, orders_weekly(spark, sf)), TV.SRC_B, check_empty=False))

    return materialized(spark, sf, "target_b", build)


SQL_TARGET_A = f"SELECT yearweek, county, disease, '{TV.SRC_A}' AS data_source, count FROM panel_a"
SQL_TARGET_B = f"SELECT yearweek, county, disease, '{TV.SRC_B}' AS data_source, count FROM panel_b"


def train_base(spark: SparkSession, sf: str, feature_set: str = "base") -> DataFrame:
    """Training rows with features, rows without lag_1 dropped (FIL-7)."""
    f = FE.lag_rolling_features(target_a(spark, sf).where(F.col("count").isNotNull()), feature_set)
    return f.where(F.col("lag_1").isNotNull() & F.col("count").isNotNull())


SQL_TRAIN_A = f"""SELECT * FROM (SELECT *, lag(count, 1) OVER (PARTITION BY {Q.KEY} ORDER BY yearweek) AS lag_1
                                 FROM ({SQL_TARGET_A}) WHERE count IS NOT NULL)
                  WHERE lag_1 IS NOT NULL AND count IS NOT NULL"""


# ---------------------------------------------------------------------------
# Flagship: seasonal-naive out-of-fold metrics by level (CV-5 + WIN-12 + AGG-4/5)
# ---------------------------------------------------------------------------
def _sn_oof_long(spark, sf, n_splits=1, min_train=52):
    train = train_base(spark, sf)
    folds = SP.fold_table(spark, SP.rolling_splits(SP.distinct_weeks(train), n_splits, min_train))
    oof = OO.local_oof_seasonal_naive(train, folds)
    truth = train.select(*C.KEY_COLS, "yearweek", F.col("count").alias("y_true"))
    return oof.join(truth, [*C.KEY_COLS, "yearweek"]).select(
        *C.KEY_COLS, "yearweek", "y_true", F.col("seasonal_naive").alias("y_pred"), F.lit("seasonal_naive").alias("model_name")
    )


def _sql_cut_folds(train_src: str) -> dict:
    return {
        "wk": f"""SELECT yearweek, row_number() OVER (ORDER BY yearweek) AS wr, count(*) OVER () AS nw
                  FROM (SELECT DISTINCT yearweek FROM {train_src})""",
        "folds": """SELECT 0 AS fold, yearweek,
                           CASE WHEN wr <= CAST(floor(nw * CAST(0.8 AS DOUBLE)) AS BIGINT) THEN 'train' ELSE 'valid' END AS role
                    FROM wk""",
    }


def _sql_sn_oof_long() -> tuple[list[str], str]:
    d = {"tr": SQL_TRAIN_A}
    d.update(_sql_cut_folds("tr"))
    d["trv"] = "SELECT t.data_source, t.disease, t.county, f.fold, t.yearweek, t.count FROM tr t JOIN folds f USING (yearweek) WHERE f.role = 'train'"
    d["va"] = """SELECT t.data_source, t.disease, t.county, f.fold, t.yearweek, t.count AS y_true,
                        row_number() OVER (PARTITION BY t.data_source, t.disease, t.county, f.fold ORDER BY t.yearweek) AS h
                 FROM tr t JOIN folds f USING (yearweek) WHERE f.role = 'valid'"""
    d.update(Q.seasonal_naive_sql("trv", "va", "data_source, disease, county, fold"))
    d["long"] = "SELECT data_source, disease, county, yearweek, y_true, seasonal_naive AS y_pred, 'seasonal_naive' AS model_name FROM sn_pred"
    return d


def _flagship_sql() -> str:
    d = _sql_sn_oof_long()
    d["hit"] = Q.hit_cte("long", ["model_name"])
    body = Q.metric_select(["data_source", "model_name"], "hit")
    return TV.with_views(body, "panel_a", extra=d)


@register("cv_05_seasonal_naive_oof_metrics", _flagship_sql())
def q_flagship(spark: SparkSession, sf: str) -> DataFrame:
    long = _sn_oof_long(spark, sf)
    return round_doubles(EV.metric_levels(long, ["data_source", "model_name"]))


# ---------------------------------------------------------------------------
# Sources and normalisation (SRC-*, COL-*)
# ---------------------------------------------------------------------------
@register("src_01_source_weekly_range", TV.with_views(
    f"SELECT * FROM ({SQL_TARGET_A}) WHERE yearweek >= 199601 AND yearweek <= 200052", "panel_a"))
def q_src_01(spark, sf):
    t = TV.Tables(spark, sf)
    return SC.normalize_target(SC.load_source_weekly(TV.panel_a(t, 199601, 200052), TV.SRC_A, 199601, 200052, check_empty=False))


SQL_SOURCE_TOTAL_A = f"""SELECT data_source, yearweek, county, min(CAST(total_count AS DOUBLE)) AS source_total_count
                        FROM source_total WHERE data_source = '{TV.SRC_A}' GROUP BY data_source, yearweek, county"""


def source_total_a(spark, sf):
    # the totals table is panel_a summed over categories: derive it from the materialised panel
    def build():
        panel = target_a(spark, sf).select("yearweek", "county", "disease", "count")
        return SC.load_source_total(TV.source_total_from(panel), TV.SRC_A)

    return materialized(spark, sf, "source_total_a", build)


@register("src_03_source_total", TV.with_views(SQL_SOURCE_TOTAL_A, "source_total"))
def q_src_03(spark, sf):
    return source_total_a(spark, sf)


@register("src_12_load_profile", TV.with_views(
    f"""SELECT data_source, count(*) AS rows, min(yearweek) AS min_yearweek, max(yearweek) AS max_yearweek
        FROM ({SQL_TARGET_A} UNION ALL {SQL_TARGET_B}) GROUP BY data_source""", "panel_a", "panel_b"))
def q_src_12(spark, sf):
    return SC.load_profile(target_a(spark, sf).unionByName(target_b(spark, sf)))


@register("col_05_unpivot_wide", TV.with_views(
    f"""SELECT yearweek, county, 'EV' AS disease, '{TV.SRC_A}' AS data_source, ev_total AS count FROM panel_a_wide
        UNION ALL SELECT yearweek, county, 'ILI', '{TV.SRC_A}', ili_total FROM panel_a_wide
        UNION ALL SELECT yearweek, county, 'DI', '{TV.SRC_A}', di_total FROM panel_a_wide""", "panel_a_wide"))
def q_col_05(spark, sf):
    t = TV.Tables(spark, sf)
    return SC.normalize_target(SC.load_source_weekly(TV.panel_a_wide(t), TV.SRC_A, check_empty=False))


SQL_WEATHER = "SELECT yearweek, city AS county, airtemperature_avg, rain_days FROM weather_weekly"


def weather(spark, sf):
    return materialized(spark, sf, "weather", lambda: SC.load_weather(TV.weather_weekly(TV.Tables(spark, sf), orders_weekly(spark, sf))))


@register("col_06_weather_normalized", TV.with_views(
    f"SELECT yearweek, county, round(airtemperature_avg, 6) AS airtemperature_avg, rain_days FROM ({SQL_WEATHER})",
    "weather_weekly"))
def q_col_06(spark, sf):
    return round_doubles(weather(spark, sf))


def calendar(spark, sf):
    from panelcast.sources.calendar import calendar_features

    def build():
        # both sides from the one week-date table: its dates cost a pass over orders and lines
        days = weekdate(spark, sf)
        return calendar_features(TV.dim_holiday(TV.Tables(spark, sf), days), days, TV.TEST_COVID_YEARS)

    return materialized(spark, sf, "calendar", build)


def weekdate(spark, sf):
    return materialized(spark, sf, "weekdate", lambda: TV.dim_weekdate(TV.Tables(spark, sf)))


@register("agg_01_calendar_rollup", TV.with_views("SELECT * FROM dim_calendar", "dim_calendar"))
def q_agg_01(spark, sf):
    return calendar(spark, sf)


BASE = TV.TEST_BASE_DATE
HORIZON = C.DEFAULT_FORECAST_PERIOD
SQL_FW = f"""SELECT yearweek, CAST(row_number() OVER (ORDER BY yearweek) AS INTEGER) AS lead_week
             FROM (SELECT DISTINCT yearweek FROM dim_weekdate
                   WHERE date BETWEEN DATE '{BASE}' AND DATE '{BASE}' + INTERVAL {7 * (HORIZON - 1)} DAY
                   ORDER BY yearweek LIMIT {HORIZON})"""
SQL_CUT = f"SELECT min(yearweek) AS train_cut_week FROM dim_weekdate WHERE date = DATE '{BASE}' - INTERVAL 7 DAY"


@register("src_09_forecast_weeks", TV.with_views(f"SELECT * FROM ({SQL_FW})", "dim_weekdate"))
def q_src_09(spark, sf):
    from pyspark.sql import Window

    from panelcast.sources.calendar import forecast_weeks_df

    fw = forecast_weeks_df(TV.dim_weekdate(TV.Tables(spark, sf)), HORIZON, BASE)
    return fw.withColumn("lead_week", F.row_number().over(Window.orderBy("yearweek")))


@register("src_08_latest_closed_week", TV.with_views(SQL_CUT, "dim_weekdate"))
def q_src_08(spark, sf):
    from panelcast.sources.calendar import latest_closed_week_df

    return latest_closed_week_df(TV.dim_weekdate(TV.Tables(spark, sf)), BASE)


# ---------------------------------------------------------------------------
# Feature table (PAN-1) and task preparation (PAN-2..5)
# ---------------------------------------------------------------------------
def forecast_weeks(spark, sf) -> list[int]:
    from panelcast.sources.calendar import forecast_yearweeks

    return materialized(spark, sf, "forecast_weeks", lambda: forecast_yearweeks(weekdate(spark, sf), HORIZON, BASE))


def train_cut(spark, sf) -> int:
    from panelcast.sources.calendar import latest_closed_yearweek

    return materialized(spark, sf, "train_cut", lambda: latest_closed_yearweek(weekdate(spark, sf), BASE))


def feature_store_a(spark, sf) -> DataFrame:
    """The feature table as downstream stages read it: built once per session and checkpointed."""
    return materialized(spark, sf, "feature_a", lambda: feature_a(spark, sf))


def feature_a(spark, sf) -> DataFrame:
    from panelcast.operators.panel import build_feature_table

    return build_feature_table(target_a(spark, sf), source_total_a(spark, sf), weather(spark, sf),
                               calendar(spark, sf), forecast_weeks(spark, sf))


SQL_FEATURE_A = {
    "tgt": SQL_TARGET_A,
    "st": SQL_SOURCE_TOTAL_A,
    "wx": SQL_WEATHER,
    "fw": SQL_FW,
    "hist": """SELECT t.yearweek, t.county, t.disease, t.data_source, t.count, st.source_total_count,
                      CASE WHEN st.source_total_count > 0 THEN t.count / st.source_total_count END AS disease_rate,
                      false AS is_future
               FROM tgt t LEFT JOIN st USING (data_source, yearweek, county)""",
    "fut": """SELECT fw.yearweek, c.county, c.disease, c.data_source, CAST(NULL AS DOUBLE) AS count,
                     st.source_total_count, CAST(NULL AS DOUBLE) AS disease_rate, true AS is_future
              FROM (SELECT DISTINCT county, disease, data_source FROM tgt) c CROSS JOIN fw
                   LEFT JOIN st USING (data_source, yearweek, county)""",
    "ft": """SELECT * FROM (SELECT * FROM hist UNION ALL SELECT * FROM fut) p
             LEFT JOIN wx USING (yearweek, county) LEFT JOIN dim_calendar USING (yearweek)""",
}
FT_VIEWS = ("panel_a", "source_total", "weather_weekly", "dim_weekdate", "dim_calendar")
FT_DOUBLES = ["count", "source_total_count", "disease_rate", "airtemperature_avg"]


def _ft_sql(body: str, extra: dict | None = None, views=()) -> str:
    d = dict(SQL_FEATURE_A)
    d.update(extra or {})
    return TV.with_views(body, *FT_VIEWS, *views, extra=d)


def _round_cols(cols, prefix="") -> str:
    return ", ".join(f"round({prefix}{c}, 6) + 0.0 AS {c}" for c in cols)


FT_BODY = f"SELECT * REPLACE ({_round_cols(FT_DOUBLES)}) FROM ft"


@register("pan_01_feature_table", _ft_sql(FT_BODY))
def q_pan_01(spark, sf):
    return round_doubles(feature_a(spark, sf))


@register("agg_12_missing_total_rows", _ft_sql(
    "SELECT count(*) FILTER (WHERE NOT is_future AND source_total_count IS NULL) AS missing_total_rows FROM ft"))
def q_agg_12(spark, sf):
    from panelcast.operators.panel import missing_total_rows

    return missing_total_rows(feature_a(spark, sf))


SQL_LOCMAP = """SELECT county_key, min(new_name) AS new_name, min(branch_t) AS branch_t FROM (
                  SELECT replace(replace(replace(trim(old_name), '臺', '台'), ' ', ''), '　', '') AS county_key,
                         trim(new_name) AS new_name, trim(branch_t) AS branch_t FROM dim_location WHERE branch_t IS NOT NULL
                  UNION
                  SELECT replace(replace(replace(trim(new_name), '臺', '台'), ' ', ''), '　', ''),
                         trim(new_name), trim(branch_t) FROM dim_location WHERE branch_t IS NOT NULL)
                GROUP BY county_key"""


def dim_location(spark, sf) -> DataFrame:
    return materialized(spark, sf, "dim_location", lambda: TV.dim_location(TV.Tables(spark, sf)))


def location_map(spark, sf):
    from panelcast.operators.locations import build_location_map

    # its checks and its rows are several jobs over the places: these are looked up in the lines once
    return materialized(spark, sf, "location_map", lambda: build_location_map(dim_location(spark, sf)))


@register("pan_02_location_map", TV.with_views(SQL_LOCMAP, "dim_location"))
def q_pan_02(spark, sf):
    return location_map(spark, sf)


def _collapse_sql(src: str, county_expr: str, drop_weather: bool = False, rounded: bool = True) -> str:
    r = (lambda e: f"round({e}, 6)") if rounded else (lambda e: e)
    wcols = [] if drop_weather else [f"{r('avg(airtemperature_avg)')} AS airtemperature_avg",
                                     f"{r('avg(CAST(rain_days AS DOUBLE))')} AS rain_days"]
    cal = [f"{r(f'avg(CAST({c} AS DOUBLE))')} AS {c}" for c in ("cnt", "voc", "eve", "ev_period", "di_period", "covid")]
    rate = "CASE WHEN sum(count) IS NOT NULL AND sum(source_total_count) > 0 THEN sum(count) / sum(source_total_count) END"
    return f"""SELECT data_source, disease, county, yearweek, is_future,
                      {r('sum(count)')} AS count, {r('sum(source_total_count)')} AS source_total_count,
                      {r(rate)} AS disease_rate,
                      {', '.join(wcols + cal)}
               FROM (SELECT * REPLACE ({county_expr} AS county) FROM {src})
               GROUP BY data_source, disease, county, yearweek, is_future"""


@register("pan_03_ev_branch_collapse", _ft_sql(
    _collapse_sql("ft f JOIN lm ON lm.county_key = replace(replace(replace(trim(f.county), '臺', '台'), ' ', ''), '　', '') "
                  f"WHERE f.disease = '{TV.TEST_EV_DISEASE}'", "lm.branch_t"),
    {"lm": SQL_LOCMAP}, views=("dim_location",)))
def q_pan_03(spark, sf):
    from panelcast.operators.panel import prepare_task

    out, _ = prepare_task(feature_a(spark, sf), TV.SRC_A, "nhi_ev_branch", location_map(spark, sf),
                          ev_disease=TV.TEST_EV_DISEASE, source_kind="nhi", check_empty=False)
    return round_doubles(out)


_OFFSHORE_SQL = ", ".join(f"'{c}'" for c in TV.TEST_OFFSHORE)


@register("pan_04_offshore_collapse", _ft_sql(_collapse_sql(
    f"ft WHERE disease <> '{TV.TEST_EV_DISEASE}'",
    f"CASE WHEN trim(county) IN ({_OFFSHORE_SQL}) THEN '{C.OFFSHORE_LABEL}' ELSE trim(county) END")))
def q_pan_04(spark, sf):
    from panelcast.operators.panel import prepare_task

    out, _ = prepare_task(feature_a(spark, sf), TV.SRC_A, "nhi_non_ev_county", ev_disease=TV.TEST_EV_DISEASE,
                          offshore=TV.TEST_OFFSHORE, source_kind="nhi", check_empty=False)
    return round_doubles(out)


@register("pan_05_national_collapse", _ft_sql(_collapse_sql(
    f"ft WHERE disease = '{TV.TEST_EV_DISEASE}'", f"'{C.NATIONAL_LABEL}'", drop_weather=True)))
def q_pan_05(spark, sf):
    from panelcast.operators.panel import prepare_task

    out, _ = prepare_task(feature_a(spark, sf), TV.SRC_A, "rods_ev_national", ev_disease=TV.TEST_EV_DISEASE,
                          source_kind="rods", check_empty=False)
    return round_doubles(out)


# ---------------------------------------------------------------------------
# Row filters (FIL-*) and window features (WIN-*)
# ---------------------------------------------------------------------------
def history_a(spark, sf, recent_weeks=None) -> DataFrame:
    """FIL-3 (+ FIL-5): training rows of the feature table up to the training cut."""
    from panelcast.operators.panel import apply_recent_weeks, training_rows

    return apply_recent_weeks(training_rows(feature_store_a(spark, sf), train_cut(spark, sf)), recent_weeks)


SQL_HIST = {"cut": SQL_CUT,
            "th": "SELECT * FROM ft WHERE NOT is_future AND count IS NOT NULL AND yearweek <= (SELECT train_cut_week FROM cut)"}


def _ft_rounded(src: str, extra_doubles=()) -> str:
    return f"SELECT * REPLACE ({_round_cols([*FT_DOUBLES, *extra_doubles])}) FROM {src}"


@register("fil_03_training_rows", _ft_sql(_ft_rounded("th"), SQL_HIST))
def q_fil_03(spark, sf):
    return round_doubles(history_a(spark, sf))


@register("fil_05_recent_weeks", _ft_sql(_ft_rounded("thr"), {
    **SQL_HIST,
    "thr": "SELECT * FROM th WHERE yearweek >= (SELECT min(yearweek) FROM (SELECT DISTINCT yearweek FROM th ORDER BY yearweek DESC LIMIT 156))"}))
def q_fil_05(spark, sf):
    return round_doubles(history_a(spark, sf, 156))


_CY = TV.TEST_COVID_YEARS


@register("fil_06_covid_exclude", _ft_sql(_ft_rounded(f"(SELECT * FROM ft WHERE NOT (yearweek // 100 BETWEEN {_CY[0]} AND {_CY[1]}) OR is_future)")))
def q_fil_06(spark, sf):
    from panelcast.operators.panel import apply_covid_policy

    return round_doubles(apply_covid_policy(feature_a(spark, sf), "exclude", _CY))


@register("col_13_covid_flag", _ft_sql(
    f"SELECT *, CAST(yearweek // 100 BETWEEN {_CY[0]} AND {_CY[1]} AS INTEGER) AS covid_period FROM ({_ft_rounded('ft')})"))
def q_col_13(spark, sf):
    from panelcast.operators.panel import apply_covid_policy

    return round_doubles(apply_covid_policy(feature_a(spark, sf), "flag", _CY))


def _win_sql(feature_set: str) -> str:
    names = Q.feature_names(feature_set)
    body = f"SELECT * REPLACE ({_round_cols([*FT_DOUBLES, *names])}) FROM (SELECT *, {', '.join(Q.feature_exprs(feature_set))} FROM th)"
    return _ft_sql(body, SQL_HIST)


@register("win_01_07_lag_rolling_medium", _win_sql("medium"))
def q_win_medium(spark, sf):
    return round_doubles(FE.lag_rolling_features(history_a(spark, sf), "medium"))


@register("win_01_07_lag_rolling_full", _win_sql("full"))
def q_win_full(spark, sf):
    return round_doubles(FE.lag_rolling_features(history_a(spark, sf), "full"))


SQL_FUTURE = {
    "fr": f"""SELECT *, CAST(row_number() OVER (PARTITION BY {Q.KEY} ORDER BY yearweek) AS INTEGER) AS lead_week
              FROM ft WHERE is_future AND yearweek IN (SELECT yearweek FROM fw)""",
    "frk": f"""SELECT * EXCLUDE (_n) FROM (SELECT *, count(*) OVER (PARTITION BY {Q.KEY}) AS _n FROM fr WHERE lead_week <= {HORIZON})
               WHERE _n = {HORIZON}""",
}


def future_a(spark, sf) -> DataFrame:
    """FIL-4 + FIL-10 + WIN-9: complete-horizon future rows with lead_week."""
    from panelcast.operators.panel import complete_horizon, future_rows

    kept, _ = complete_horizon(future_rows(feature_store_a(spark, sf), forecast_weeks(spark, sf)), HORIZON)
    return kept


@register("fil_10_complete_horizon", _ft_sql(_ft_rounded("frk"), SQL_FUTURE))
def q_fil_10(spark, sf):
    return round_doubles(future_a(spark, sf))


def _future_sql(feature_set: str) -> str:
    d = {**SQL_HIST, **SQL_FUTURE}
    names = []
    for m, p, nm in (("count", "", "cf"), ("source_total_count", "source_total_count_", "tf"), ("disease_rate", "disease_rate_", "rf")):
        d.update(Q.future_feature_ctes("th", m, p, feature_set, HORIZON, nm))
    names = Q.feature_names(feature_set)
    body = f"""SELECT * REPLACE ({_round_cols([*FT_DOUBLES, *names])}) FROM
               (SELECT * FROM frk JOIN cf USING ({Q.KEY}, lead_week) LEFT JOIN tf USING ({Q.KEY}, lead_week)
                              LEFT JOIN rf USING ({Q.KEY}, lead_week))"""
    return _ft_sql(body, d)


@register("win_10_future_features", _future_sql("medium"))
def q_win_10(spark, sf):
    return round_doubles(FE.future_features(history_a(spark, sf), future_a(spark, sf), "medium", HORIZON))


@register("win_10_future_features_full", _future_sql("full"))
def q_win_10_full(spark, sf):
    return round_doubles(FE.future_features(history_a(spark, sf), future_a(spark, sf), "full", HORIZON))


def _sn_forecast_sql() -> str:
    d = {**SQL_HIST, **SQL_FUTURE}
    d["trn"] = f"""SELECT * FROM (SELECT *, lag(count, 1) OVER (PARTITION BY {Q.KEY} ORDER BY yearweek) AS _l1 FROM th)
                   WHERE _l1 IS NOT NULL AND count IS NOT NULL"""
    d["tg"] = f"SELECT {Q.KEY}, yearweek, lead_week AS h FROM frk"
    d.update(Q.seasonal_naive_sql("trn", "tg", Q.KEY))
    return _ft_sql(f"SELECT {Q.KEY}, yearweek, round(seasonal_naive, 6) AS seasonal_naive FROM sn_pred", d)


def train_a(spark, sf, feature_set="base") -> DataFrame:
    """Training rows with window features; rows without lag_1 or count dropped (FIL-7)."""
    f = FE.lag_rolling_features(history_a(spark, sf), feature_set)
    return f.where(F.col("lag_1").isNotNull() & F.col("count").isNotNull())


@register("win_12_seasonal_naive_forecast", _sn_forecast_sql())
def q_win_12(spark, sf):
    return round_doubles(OO.final_seasonal_naive(train_a(spark, sf), future_a(spark, sf)))


@register("win_08_directional_hit", TV.with_views(
    f"SELECT {Q.KEY}, yearweek, y_true, round(y_pred, 6) AS y_pred, model_name, _hit AS hit FROM hit", "panel_a",
    extra={**_sql_sn_oof_long(), "hit": Q.hit_cte("long", ["model_name"])}))
def q_win_08(spark, sf):
    out = EV.with_hit(_sn_oof_long(spark, sf), ["model_name"])
    return round_doubles(out.withColumnRenamed("_hit", "hit"))


# ---------------------------------------------------------------------------
# Prediction matrix, combiners, metric table and reports
# ---------------------------------------------------------------------------
BASE_MODELS = ["seasonal_naive", "lag_1", "roll4_mean"]  # seasonal naive + two features standing in as base predictions
OOF_SPLITS, OOF_MIN_TRAIN = 2, 104
META_METHOD = "weighted_average"
CTX = {"model_task": "default", "model_scope": "county", "prediction_type": "oof"}


def oof_matrix_a(spark, sf) -> DataFrame:
    """CV-1 + CV-5 + JOI-15: validation rows of each fold with one column per base prediction.

    Materialised once: the base metrics and the meta OOF both read it.
    """
    def build():
        train = train_a(spark, sf)
        folds = SP.fold_table(spark, SP.rolling_splits(SP.distinct_weeks(train), OOF_SPLITS, OOF_MIN_TRAIN))
        sn = OO.local_oof_seasonal_naive(train, folds)
        va = SP.assign_folds(train, folds, "valid").select(*C.KEY_COLS, "yearweek", F.col("count").alias("y_true"), "lag_1", "roll4_mean")
        return va.join(sn, [*C.KEY_COLS, "yearweek"], "left")

    return materialized(spark, sf, "oof_matrix_a", build)


def _sql_oof_matrix() -> dict:
    d = {**SQL_HIST}
    d["trn"] = f"""SELECT * FROM (SELECT *, lag(count, 1) OVER (PARTITION BY {Q.KEY} ORDER BY yearweek) AS lag_1,
                                    avg(count) OVER (PARTITION BY {Q.KEY} ORDER BY yearweek ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS roll4_mean
                             FROM th) WHERE lag_1 IS NOT NULL AND count IS NOT NULL"""
    d.update(Q.rolling_fold_ctes("trn", OOF_SPLITS, OOF_MIN_TRAIN, "folds"))
    d["trv"] = f"SELECT t.data_source, t.disease, t.county, f.fold, t.yearweek, t.count FROM trn t JOIN folds f USING (yearweek) WHERE f.role = 'train'"
    d["va"] = f"""SELECT t.data_source, t.disease, t.county, f.fold, t.yearweek,
                         row_number() OVER (PARTITION BY t.data_source, t.disease, t.county, f.fold ORDER BY t.yearweek) AS h
                  FROM trn t JOIN folds f USING (yearweek) WHERE f.role = 'valid'"""
    d.update(Q.seasonal_naive_sql("trv", "va", "data_source, disease, county, fold"))
    d["mx"] = f"""SELECT t.data_source, t.disease, t.county, t.yearweek, t.count AS y_true, t.lag_1, t.roll4_mean, s.seasonal_naive
                  FROM trn t JOIN folds f ON f.yearweek = t.yearweek AND f.role = 'valid'
                  LEFT JOIN sn_pred s ON s.data_source = t.data_source AND s.disease = t.disease AND s.county = t.county
                                      AND s.yearweek = t.yearweek"""
    return d


@register("joi_15_prediction_matrix", _ft_sql(
    f"SELECT * REPLACE (round(seasonal_naive, 6) AS seasonal_naive, round(roll4_mean, 6) AS roll4_mean) FROM mx", _sql_oof_matrix()))
def q_joi_15(spark, sf):
    return round_doubles(oof_matrix_a(spark, sf))


def _base_long_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT {Q.KEY}, yearweek, y_true, {m} AS y_pred, '{m}' AS model_name FROM mx WHERE {m} IS NOT NULL" for m in BASE_MODELS
    )


def base_metrics_a(spark, sf, meta_eval_type: str) -> DataFrame:
    long = EV.to_long(oof_matrix_a(spark, sf), [*C.KEY_COLS, "yearweek", "y_true"], BASE_MODELS)
    long = EV.with_context(long, {**CTX, "model_layer": "base", "meta_model": META_METHOD, "meta_eval_type": meta_eval_type})
    return EV.metric_levels(long, METRIC_GROUP)


METRIC_GROUP = ["data_source", "model_task", "model_scope", "model_layer", "model_name", "prediction_type", "meta_model", "meta_eval_type"]


def _ctx_sql(layer: str, name: str | None = None, eval_type: str = "rolling_meta_oof", method: str = META_METHOD) -> str:
    nm = f"'{name}' AS model_name, " if name else ""
    return (f"'{CTX['model_task']}' AS model_task, '{CTX['model_scope']}' AS model_scope, '{layer}' AS model_layer, {nm}"
            f"'{CTX['prediction_type']}' AS prediction_type, '{method}' AS meta_model, '{eval_type}' AS meta_eval_type")


def _sql_metric_table(method: str = META_METHOD) -> dict:
    d = _sql_oof_matrix()
    d["blong"] = f"SELECT *, {_ctx_sql('base')} FROM ({_base_long_sql()})"
    d["bhit"] = Q.hit_cte("blong", ["model_name"])
    d["bmet"] = Q.metric_select(METRIC_GROUP, "bhit")
    # meta OOF of the rule-based combiner (CV-6 + COM-3)
    d["sv"] = "SELECT * FROM mx WHERE y_true IS NOT NULL AND " + " AND ".join(f"{m} IS NOT NULL" for m in BASE_MODELS)
    d.update(Q.rolling_fold_ctes("sv", 2, 12, "mfolds"))
    melt = lambda src: " UNION ALL ".join(
        f"SELECT f.fold, s.data_source, s.disease, s.county, s.yearweek, s.y_true, s.{m} AS y_pred, '{m}' AS model_name, {i} AS _model_pos "
        f"FROM sv s JOIN mfolds f ON f.yearweek = s.yearweek AND f.role = '{src}'" for i, m in enumerate(BASE_MODELS))
    d["mfit"] = melt("train")
    d.update(Q.rule_weight_ctes("mfit", method, C.DEFAULT_ENSEMBLE_TOPK, "mw"))
    d["mval"] = melt("valid")
    term = lambda i, m: (f"max(CASE WHEN v._model_pos = {i} THEN v.y_pred END) * "  # noqa: E731
                         f"max(CASE WHEN v._model_pos = {i} THEN w.weight END)")
    total = "0.0::DOUBLE"
    for i, m in enumerate(BASE_MODELS):
        total = f"({total} + {term(i, m)})"
    d["mpred"] = f"""SELECT v.data_source, v.disease, v.county, v.yearweek, greatest({total}, 0.0) AS y_pred
                     FROM mval v JOIN mw w ON w.fold = v.fold AND w.model_name = v.model_name
                     GROUP BY v.fold, v.data_source, v.disease, v.county, v.yearweek"""
    d["clong"] = f"""SELECT s.data_source, s.disease, s.county, s.yearweek, s.y_true, p.y_pred,
                            {_ctx_sql('ensemble', C.combiner_model_name(method), method=method)}
                     FROM sv s LEFT JOIN mpred p USING ({Q.KEY}, yearweek)"""
    d["chit"] = Q.hit_cte("clong", ["model_name"])
    d["cmet"] = Q.metric_select(METRIC_GROUP, "chit")
    d["metric"] = "SELECT * FROM bmet UNION ALL SELECT * FROM cmet"
    return d


def combiner_metrics_a(spark, sf, method: str = META_METHOD):
    from panelcast.operators.combine import complete_cases, meta_oof_rule

    mx = oof_matrix_a(spark, sf)
    ids = [*C.KEY_COLS, "yearweek"]
    pred, eval_type = meta_oof_rule(mx, BASE_MODELS, method, ids, OOF_SPLITS)
    sv = complete_cases(mx, BASE_MODELS).select(*ids, "y_true")
    long = sv.join(pred, ids, "left")
    long = EV.with_context(long, {**CTX, "model_layer": C.combiner_layer(method),
                                  "model_name": C.combiner_model_name(method), "meta_model": method,
                                  "meta_eval_type": eval_type})
    return EV.metric_levels(long, METRIC_GROUP), eval_type


def metric_table_a(spark, sf) -> DataFrame:
    """SET-2: base and combiner metric rows of one task."""
    comb, eval_type = combiner_metrics_a(spark, sf)
    return base_metrics_a(spark, sf, eval_type).unionByName(comb)


@register("agg_05_metric_table", _ft_sql("SELECT * FROM metric", _sql_metric_table()))
def q_agg_05(spark, sf):
    return round_doubles(metric_table_a(spark, sf))


def metric_rounded(spark, sf) -> DataFrame:
    """The stored metric table (a run persists it once; every report reads it)."""
    return materialized(spark, sf, "metric_a", lambda: round_doubles(metric_table_a(spark, sf)))


_MM_SQL = ("concat_ws('/', CASE WHEN model_task NOT IN ('', 'nan', 'None', 'NaN', '<NA>', 'default') THEN model_task END, "
           "CASE WHEN model_layer NOT IN ('', 'nan', 'None', 'NaN', '<NA>') THEN model_layer END, "
           "coalesce(CASE WHEN model_name NOT IN ('', 'nan', 'None', 'NaN', '<NA>') THEN model_name END, 'unknown'))")
_COMPACT = f"data_source, {_MM_SQL} AS model_method, metric_level, {', '.join(Q.METRICS)}, disease, county"


def _metric_sql(body: str, extra: dict | None = None) -> str:
    d = _sql_metric_table()
    d.update(extra or {})
    return _ft_sql(body, d)


@register("rep_05_leaderboard", _metric_sql(f"SELECT {_COMPACT} FROM metric WHERE metric_level = 'overall'"))
def q_rep_05(spark, sf):
    from panelcast.operators.reports import leaderboard

    return leaderboard(metric_rounded(spark, sf))


@register("rep_06_breakdown_top200", _metric_sql(
    f"""SELECT * FROM (SELECT {_COMPACT} FROM metric
                       WHERE metric_level IN ('by_disease', 'by_county', 'by_disease_county', 'by_lead_week'))
        ORDER BY WAPE DESC NULLS LAST, model_method, metric_level, disease, county LIMIT 200"""))
def q_rep_06(spark, sf):
    from panelcast.operators.reports import breakdown

    return breakdown(metric_rounded(spark, sf), 200)


_BEST_SQL = """SELECT data_source, model_task, model_scope, model_name AS best_base_model, WAPE AS best_base_wape
               FROM (SELECT *, row_number() OVER (PARTITION BY data_source, model_task, model_scope ORDER BY WAPE, model_name) AS rk
                     FROM metric WHERE metric_level = 'overall' AND model_layer = 'base' AND WAPE IS NOT NULL) WHERE rk = 1"""


@register("agg_13_best_base_model", _metric_sql("SELECT * FROM best", {"best": _BEST_SQL}))
def q_agg_13(spark, sf):
    from panelcast.operators.reports import best_base

    return best_base(metric_rounded(spark, sf))


@register("rep_07_meta_model_comparison", _metric_sql(
    """SELECT c.data_source, c.model_task, c.model_scope, c.model_layer, c.meta_model, c.meta_eval_type, c.model_name,
              c.n_obs, c.WAPE, c.MAE, c.RMSE, c.Bias, b.best_base_model, b.best_base_wape,
              c.WAPE - b.best_base_wape AS wape_vs_best_base, coalesce(c.WAPE - b.best_base_wape < 0, false) AS stacking_wins
       FROM metric c LEFT JOIN best b ON b.data_source IS NOT DISTINCT FROM c.data_source
            AND b.model_task IS NOT DISTINCT FROM c.model_task AND b.model_scope IS NOT DISTINCT FROM c.model_scope
       WHERE c.metric_level = 'overall' AND c.model_layer IN ('stacking', 'ensemble')""", {"best": _BEST_SQL}))
def q_rep_07(spark, sf):
    from panelcast.operators.reports import meta_model_comparison

    return meta_model_comparison(metric_rounded(spark, sf))


@register("rep_01_final_model_choice", _metric_sql(
    f"""SELECT coalesce(b.data_source, s.data_source) AS data_source, coalesce(b.model_task, s.model_task) AS model_task,
               CASE WHEN s.meta_eval_type = 'rolling_meta_oof' AND s.WAPE IS NOT NULL AND (b.best_base_wape IS NULL OR s.WAPE < b.best_base_wape)
                    THEN s.model_name WHEN b.best_base_model IS NOT NULL THEN b.best_base_model ELSE '{C.combiner_model_name(META_METHOD)}' END AS final_model_name,
               CASE WHEN s.meta_eval_type = 'rolling_meta_oof' AND s.WAPE IS NOT NULL AND (b.best_base_wape IS NULL OR s.WAPE < b.best_base_wape)
                    THEN s.model_layer WHEN b.best_base_model IS NOT NULL THEN 'base' ELSE '{C.combiner_layer(META_METHOD)}' END AS final_model_layer,
               CASE WHEN s.meta_eval_type = 'rolling_meta_oof' AND s.WAPE IS NOT NULL AND (b.best_base_wape IS NULL OR s.WAPE < b.best_base_wape)
                    THEN s.WAPE WHEN b.best_base_model IS NOT NULL THEN b.best_base_wape END AS selected_wape
        FROM best b FULL JOIN (SELECT * FROM metric WHERE metric_level = 'overall' AND model_name = '{C.combiner_model_name(META_METHOD)}') s
             USING (data_source, model_task)""", {"best": _BEST_SQL}))
def q_rep_01(spark, sf):
    m = metric_rounded(spark, sf)
    eval_type = m.where(F.col("model_layer") != "base").select("meta_eval_type").first()[0]
    return EV.select_final_model(m, META_METHOD, eval_type)


RUN_SETTINGS = {"task": "forecast", "run_mode": "fast", "sources": TV.SRC_A, "forecast_period": HORIZON,
                "feature_set": "base", "meta_model": META_METHOD, "covid_policy": "include"}


@register("agg_15_run_summary", _metric_sql(
    f"""SELECT {', '.join(f"'{v}' AS {k}" if isinstance(v, str) else f'{v} AS {k}' for k, v in RUN_SETTINGS.items())},
               count(*) AS metric_rows, count(*) FILTER (WHERE metric_level = 'overall') AS leaderboard_rows,
               arg_min({_MM_SQL}, (WAPE IS NULL, WAPE, {_MM_SQL})) FILTER (WHERE metric_level = 'overall') AS best_model_by_wape,
               min(WAPE) FILTER (WHERE metric_level = 'overall') AS best_wape
        FROM metric"""))
def q_agg_15(spark, sf):
    from panelcast.operators.reports import run_summary

    return run_summary(metric_rounded(spark, sf), RUN_SETTINGS)


# ---------------------------------------------------------------------------
# End-to-end runs (PAN-7, CV-8): Spark ML models, rows-only check
# ---------------------------------------------------------------------------
def task_inputs(spark, sf):
    from panelcast.plans.forecast import TaskInputs

    return TaskInputs(target_a(spark, sf), source_total_a(spark, sf), weather(spark, sf), calendar(spark, sf),
                      weekdate(spark, sf), location_map(spark, sf))


def run_options(**kw):
    from panelcast.plans.forecast import RunOptions

    # all weeks of the panel; the pool is the one that the twins name (models=None: the run mode's own)
    base = dict(run_mode="smoke", recent_weeks=0, models=("seasonal_naive", "ridge", "elasticnet"), meta_model="ridge",
                ev_disease=TV.TEST_EV_DISEASE,
                offshore=TV.TEST_OFFSHORE, source_kind="nhi", covid_years=TV.TEST_COVID_YEARS)
    base.update(kw)
    return RunOptions(**base)


RUN_TASK = "nhi_non_ev_county"
HOLDOUT_N = 8


def forecast_run_a(spark, sf) -> dict[str, DataFrame]:
    """One forecast run per session with the pool of the twins; the queries that have one read its outputs."""
    from panelcast.plans.forecast import run_forecast

    return materialized(spark, sf, "forecast_run", lambda: run_forecast(
        task_inputs(spark, sf), TV.SRC_A, RUN_TASK, BASE, run_options()))


def holdout_run_a(spark, sf) -> dict:
    from panelcast.plans.forecast import run_holdout

    return materialized(spark, sf, "holdout_run", lambda: run_holdout(
        task_inputs(spark, sf), TV.SRC_A, RUN_TASK, BASE, train_cut(spark, sf), HOLDOUT_N,
        run_options(meta_model="weighted_average")))


def full_run_a(spark, sf) -> dict[str, DataFrame]:
    """One forecast run per session with the run mode's own pool; boosted models at the iterations of their presets."""
    from panelcast.plans.forecast import run_forecast

    return materialized(spark, sf, "full_run", lambda: run_forecast(
        task_inputs(spark, sf), TV.SRC_A, RUN_TASK, BASE, run_options(models=None)))


@register("pan_07_forecast_run")
def q_pan_07(spark, sf):
    return full_run_a(spark, sf)["forecast"]


#: The tasks of the back-test: the branch task takes the Poisson models and the importance selection.
HOLDOUT_TASKS = {RUN_TASK: {}, "nhi_ev_branch": {"feature_select": "lgbm_topk", "top_k": 12}}


@register("cv_08_holdout_run")
def q_cv_08(spark, sf):
    """Metric rows of both tasks with the run mode's own pool; boosted models at the iterations of their presets."""
    from panelcast.plans.forecast import run_holdout

    out = None
    for task, kw in HOLDOUT_TASKS.items():
        metric = run_holdout(task_inputs(spark, sf), TV.SRC_A, task, BASE, train_cut(spark, sf), HOLDOUT_N,
                             run_options(models=None, meta_model="weighted_average", **kw))["metric"]
        out = metric if out is None else out.unionByName(metric)
    return out


#: The panel of the run's task: offshore places collapsed, EV rows left out.
SQL_TASK_HIST = {
    "cut": SQL_CUT,
    "off": _collapse_sql(f"ft WHERE disease <> '{TV.TEST_EV_DISEASE}'",
                         f"CASE WHEN trim(county) IN ({_OFFSHORE_SQL}) THEN '{C.OFFSHORE_LABEL}' ELSE trim(county) END",
                         rounded=False),
    "th": "SELECT * FROM off WHERE NOT is_future AND count IS NOT NULL AND yearweek <= (SELECT train_cut_week FROM cut)",
}
SQL_TASK_FUTURE = {
    "fr": SQL_FUTURE["fr"].replace("FROM ft ", "FROM off "),
    "frk": SQL_FUTURE["frk"],
    "trn": f"""SELECT * FROM (SELECT *, lag(count, 1) OVER (PARTITION BY {Q.KEY} ORDER BY yearweek) AS lag_1 FROM th)
               WHERE lag_1 IS NOT NULL AND count IS NOT NULL""",
}
_RUN_FLAGS = f"'{RUN_TASK}' AS model_task, 'county' AS model_scope, false AS is_rods_ev_national, true AS is_offshore_collapsed, false AS weather_removed"
_RUN_SETTINGS = ("'smoke' AS run_mode, 'base' AS feature_set, 'filter' AS feature_select, CAST(NULL AS INTEGER) AS top_k, "
                 "'include' AS covid_policy, false AS enable_grid_search")


@register("rep_03_forecast_rows", _ft_sql(
    f"SELECT {Q.KEY}, yearweek, lead_week, {_RUN_FLAGS}, {_RUN_SETTINGS} FROM frk", {**SQL_TASK_HIST, **SQL_TASK_FUTURE}))
def q_rep_03(spark, sf):
    """Rows, flags and settings of the run's forecast: all that does not hang on a fitted model."""
    return forecast_run_a(spark, sf)["forecast"].drop("forecast_count", "forecast_count_rounded", "model_name", "model_layer")


@register("pan_07_base_prediction_rows", _ft_sql(
    f"""SELECT {Q.KEY}, yearweek, lead_week, m.base_model, {_RUN_FLAGS}, 'smoke' AS run_mode, 'base' AS feature_set
        FROM frk, (VALUES ('seasonal_naive'), ('ridge'), ('lightgbm')) m(base_model)""", {**SQL_TASK_HIST, **SQL_TASK_FUTURE}))
def q_pan_07_rows(spark, sf):
    """Rows, flags and settings of the run with the run mode's own pool: one per future row and model of the pool."""
    return full_run_a(spark, sf)["base_prediction"].drop("forecast_count")


#: Features of the report whose profile the twin repeats; the run's report holds more.
REPORT_COLS = ["lag_1", "lag_2", "lag_4", "lag_8", "roll4_mean", "roll8_mean", "roll4_std", "roll8_std", "source_total_count_lag_1",
               "disease_rate_lag_1", "airtemperature_avg", "rain_days", "cnt", "voc"]


def _sql_feature_report() -> str:
    d = {**SQL_TASK_HIST}
    d["trb"] = f"""SELECT * FROM (SELECT *, {', '.join(Q.feature_exprs('base'))} FROM th) WHERE lag_1 IS NOT NULL AND count IS NOT NULL"""
    num = " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, 'numeric' AS feature_type, 'filter' AS selection_stage,
                   round(avg(CASE WHEN {c} IS NULL OR isnan(CAST({c} AS DOUBLE)) THEN 1.0 ELSE 0.0 END), 5) AS missing_rate,
                   round(avg(CAST({c} AS DOUBLE)), 5) AS mean, round(min(CAST({c} AS DOUBLE)), 5) AS min, round(max(CAST({c} AS DOUBLE)), 5) AS max
            FROM trb""" for c in REPORT_COLS)
    cat = " UNION ALL ".join(
        f"""SELECT '{c}', 'categorical', 'categorical', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)"""
        for c in C.CATEGORICAL_COLS)
    return _ft_sql(f"SELECT *, '{TV.SRC_A}' AS data_source, '{RUN_TASK}' AS model_task FROM ({num} UNION ALL {cat})", d)


@register("rep_04_feature_report", _sql_feature_report())
def q_rep_04_report(spark, sf):
    """SET-9: the run's feature report, numeric and categorical rows."""
    report = forecast_run_a(spark, sf)["feature_report"]
    rows = report.where((F.col("feature_type") == "categorical") | F.col("feature").isin(*REPORT_COLS))
    return round_doubles(rows.select("feature", "feature_type", "selection_stage", "missing_rate", "mean", "min", "max", "data_source", "model_task"), 5)


@register("rep_04_base_prediction_rows", _ft_sql(
    f"""SELECT {Q.KEY}, yearweek, lead_week, m.base_model, {_RUN_FLAGS}, 'smoke' AS run_mode, 'base' AS feature_set
        FROM frk, (VALUES ('seasonal_naive'), ('ridge'), ('elasticnet')) m(base_model)""", {**SQL_TASK_HIST, **SQL_TASK_FUTURE}))
def q_rep_04(spark, sf):
    return forecast_run_a(spark, sf)["base_prediction"].drop("forecast_count")


@register("mod_10_naive_final_predictions", _ft_sql(
    f"""SELECT {Q.KEY}, yearweek, h AS lead_week, 'seasonal_naive' AS base_model,
               CAST(greatest(round_even(coalesce(seasonal_naive, 0.0), 0), 0) AS BIGINT) AS forecast_count,
               {_RUN_FLAGS}, 'smoke' AS run_mode, 'base' AS feature_set FROM sn_pred""", {
        **SQL_TASK_HIST, **SQL_TASK_FUTURE, "tg": f"SELECT {Q.KEY}, yearweek, lead_week AS h FROM frk",
        **Q.seasonal_naive_sql("trn", "tg", Q.KEY)}))
def q_mod_10(spark, sf):
    """The run's refitted naive model: its published base predictions."""
    return forecast_run_a(spark, sf)["base_prediction"].where("base_model = 'seasonal_naive'")


def _run_metric_sql() -> str:
    group = ["data_source", "model_task", "model_scope", "prediction_type", "model_layer", "model_name"]
    d = {**SQL_TASK_HIST, "trn": SQL_TASK_FUTURE["trn"], **_sql_cut_folds("trn")}
    d["trv"] = "SELECT t.data_source, t.disease, t.county, f.fold, t.yearweek, t.count FROM trn t JOIN folds f USING (yearweek) WHERE f.role = 'train'"
    d["va"] = """SELECT t.data_source, t.disease, t.county, f.fold, t.yearweek, t.count AS y_true,
                        row_number() OVER (PARTITION BY t.data_source, t.disease, t.county, f.fold ORDER BY t.yearweek) AS h
                 FROM trn t JOIN folds f USING (yearweek) WHERE f.role = 'valid'"""
    d.update(Q.seasonal_naive_sql("trv", "va", "data_source, disease, county, fold"))
    d["long"] = f"""SELECT {Q.KEY}, yearweek, y_true, seasonal_naive AS y_pred, '{RUN_TASK}' AS model_task, 'county' AS model_scope,
                           'oof' AS prediction_type, 'base' AS model_layer, 'seasonal_naive' AS model_name FROM sn_pred"""
    d["hit"] = Q.hit_cte("long", ["model_name"])
    d["met"] = Q.metric_select(group, "hit")
    return _ft_sql(f"SELECT *, 'ridge' AS meta_model, 'rolling_meta_oof' AS meta_eval_type, {_RUN_SETTINGS} FROM met", d)


@register("rep_02_run_naive_metrics", _run_metric_sql())
def q_rep_02(spark, sf):
    """Metric rows of the run's naive model: folds, prediction matrix, levels and settings as the run made them."""
    return round_doubles(forecast_run_a(spark, sf)["metric"].where("model_name = 'seasonal_naive'"))


# ---------------------------------------------------------------------------
# Combiner variants, weights and WAPE definitions (COM-2, COM-4, COM-12, AGG-7, AGG-8)
# ---------------------------------------------------------------------------
@register("com_02_simple_average_oof_metrics", _ft_sql("SELECT * FROM cmet", _sql_metric_table("simple_average")))
def q_com_02(spark, sf):
    return round_doubles(combiner_metrics_a(spark, sf, "simple_average")[0])


@register("com_04_topk_average_oof_metrics", _ft_sql("SELECT * FROM cmet", _sql_metric_table("topk_average")))
def q_com_04(spark, sf):
    return round_doubles(combiner_metrics_a(spark, sf, "topk_average")[0])


def _sql_full_fit_weights(method: str) -> str:
    d = _sql_metric_table(method)
    d["afit"] = " UNION ALL ".join(
        f"SELECT 0 AS fold, y_true, {m} AS y_pred, '{m}' AS model_name, {i} AS _model_pos FROM sv" for i, m in enumerate(BASE_MODELS))
    d.update(Q.rule_weight_ctes("afit", method, C.DEFAULT_ENSEMBLE_TOPK, "aw"))
    return _ft_sql(f"SELECT '{method}' AS meta_model, model_name AS base_model, round(weight, 6) AS weight FROM aw", d)


def _weights(spark, sf, method):
    from panelcast.operators.combine import extract_weights
    from panelcast.operators.stacking import fit_combiner

    meta = fit_combiner(oof_matrix_a(spark, sf), BASE_MODELS, method)
    return round_doubles(extract_weights(meta.model, method))


@register("com_12_weighted_average_weights", _sql_full_fit_weights("weighted_average"))
def q_com_12_w(spark, sf):
    return _weights(spark, sf, "weighted_average")


@register("com_12_topk_average_weights", _sql_full_fit_weights("topk_average"))
def q_com_12_t(spark, sf):
    return _weights(spark, sf, "topk_average")


@register("agg_07_08_wape_variants", _ft_sql(
    """SELECT model_name,
              round(CASE WHEN sum(abs(y_true)) = 0 THEN 0.0 ELSE sum(abs(y_pred - y_true)) / sum(abs(y_true)) END, 6) AS wape_tuning,
              round(CASE WHEN sum(abs(y_true)) = 0 THEN CAST('inf' AS DOUBLE) ELSE sum(abs(y_pred - y_true)) / sum(abs(y_true)) END, 6) AS wape_weighting
       FROM blong GROUP BY model_name""", _sql_metric_table()))
def q_agg_07(spark, sf):
    from panelcast.functions.metrics import wape_tuning, wape_weighting

    long = EV.to_long(oof_matrix_a(spark, sf), [*C.KEY_COLS, "yearweek", "y_true"], BASE_MODELS)
    return round_doubles(long.groupBy("model_name").agg(wape_tuning().alias("wape_tuning"), wape_weighting().alias("wape_weighting")))


# ---------------------------------------------------------------------------
# Feature profile, medians, constant-target test, feature-table summary (AGG-9, AGG-11, AGG-14, AGG-17)
# ---------------------------------------------------------------------------
# distinct counts of rolling std values depend on float rounding of the engine, so they stay out of the check
PROFILE_COLS = ["lag_1", "lag_2", "lag_4", "lag_8", "roll4_mean", "roll8_mean",
                "source_total_count_lag_1", "disease_rate_lag_1", "airtemperature_avg", "rain_days", "cnt", "voc"]


def _sql_train_base() -> dict:
    d = {**SQL_HIST}
    d["trb"] = f"""SELECT * FROM (SELECT *, {', '.join(Q.feature_exprs('base'))} FROM th)
                   WHERE lag_1 IS NOT NULL AND count IS NOT NULL"""
    return d


_DTYPES = {"rain_days": "bigint", "cnt": "double", "voc": "double"}


@register("agg_09_feature_profile", _ft_sql(" UNION ALL ".join(
    f"""SELECT '{c}' AS feature, '{_DTYPES.get(c, "double")}' AS dtype,
               round(avg(CASE WHEN {c} IS NULL OR isnan(CAST({c} AS DOUBLE)) THEN 1.0 ELSE 0.0 END), 6) AS missing_rate,
               round(avg(CASE WHEN coalesce(CAST({c} AS DOUBLE), 0.0) = 0 THEN 1.0 ELSE 0.0 END), 6) AS zero_rate,
               count(DISTINCT CAST({c} AS DOUBLE)) AS n_unique, round(avg(CAST({c} AS DOUBLE)), 6) AS mean,
               round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS std, round(min(CAST({c} AS DOUBLE)), 6) AS min,
               round(max(CAST({c} AS DOUBLE)), 6) AS max
        FROM (SELECT * REPLACE (CAST(cnt AS DOUBLE) AS cnt, CAST(voc AS DOUBLE) AS voc) FROM trb)""" for c in PROFILE_COLS), _sql_train_base()))
def q_agg_09(spark, sf):
    from panelcast.operators.selection import profile_features

    tr = train_a(spark, sf).withColumn("cnt", F.col("cnt").cast("double")).withColumn("voc", F.col("voc").cast("double"))
    return round_doubles(profile_features(tr, PROFILE_COLS))


@register("agg_11_feature_medians", _ft_sql(
    "SELECT " + ", ".join(f"round(median({c}), 6) AS {c}" for c in PROFILE_COLS[:6]) + " FROM trb", _sql_train_base()))
def q_agg_11(spark, sf):
    from panelcast.operators.selection import column_medians

    med = column_medians(train_a(spark, sf), PROFILE_COLS[:6])
    row = spark.createDataFrame([tuple(med[c] for c in PROFILE_COLS[:6])], ", ".join(f"{c} double" for c in PROFILE_COLS[:6]))
    return round_doubles(row)


STD_COLS = ["roll4_std", "roll8_std"]


@register("agg_11_all_feature_medians", _ft_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(median(CAST({c} AS DOUBLE)), 6) AS median FROM trb" for c in [*PROFILE_COLS, *STD_COLS]), _sql_train_base()))
def q_agg_11_all(spark, sf):
    from panelcast.operators.selection import column_medians

    med = column_medians(train_a(spark, sf), [*PROFILE_COLS, *STD_COLS])
    return round_doubles(spark.createDataFrame(list(med.items()), "feature string, median double"))


@register("agg_09_rolling_std_profile", _ft_sql(" UNION ALL ".join(
    f"""SELECT '{c}' AS feature, 'double' AS dtype, round(avg(CASE WHEN {c} IS NULL OR isnan({c}) THEN 1.0 ELSE 0.0 END), 5) AS missing_rate,
               round(avg({c}), 5) AS mean, round(stddev_samp({c}), 5) AS std, round(min({c}), 5) AS min, round(max({c}), 5) AS max FROM trb"""
    for c in STD_COLS), _sql_train_base()))
def q_agg_09_std(spark, sf):
    """Without the two columns that count exact values, which differ by rounding between engines."""
    from panelcast.operators.selection import profile_features

    return round_doubles(profile_features(train_a(spark, sf), STD_COLS).drop("zero_rate", "n_unique"), 5)


@register("agg_14_constant_series", _ft_sql(
    f"""SELECT {Q.KEY}, count(DISTINCT count) <= 1 AS is_constant,
               CASE WHEN count(DISTINCT count) <= 1 THEN round(coalesce(max(count), 0.0), 6) END AS value FROM th GROUP BY ALL""",
    SQL_HIST))
def q_agg_14(spark, sf):
    from panelcast.operators.models import constant_targets

    return round_doubles(constant_targets(history_a(spark, sf), "count", C.KEY_COLS))


# ---------------------------------------------------------------------------
# Fitted parts with a closed form (MOD-1, MOD-2, MOD-3, COM-10)
# ---------------------------------------------------------------------------
def _sql_imputed(c: str) -> str:
    return f"coalesce(CAST({c} AS DOUBLE), (SELECT median(CAST({c} AS DOUBLE)) FROM trb), 0.0)"


@register("mod_01_preprocess_statistics", _ft_sql(" UNION ALL ".join(
    f"""SELECT '{c}' AS feature, round((SELECT median(CAST({c} AS DOUBLE)) FROM trb), 6) AS median, round(avg(x), 6) AS mean,
               round(CASE WHEN stddev_pop(x) > 0 THEN stddev_pop(x) ELSE 1.0 END, 6) AS scale
        FROM (SELECT {_sql_imputed(c)} AS x FROM trb)""" for c in PROFILE_COLS), _sql_train_base()))
def q_mod_01(spark, sf):
    from panelcast.operators.models import fit_preprocess

    pre = fit_preprocess(train_a(spark, sf), PROFILE_COLS, [])
    rows = [(c, pre.medians[c], pre.means[c], pre.scales[c]) for c in PROFILE_COLS]
    return round_doubles(spark.createDataFrame(rows, "feature string, median double, mean double, scale double"))


#: One-feature fits: the coefficient on the standardised feature has a closed form.
LINEAR_FITS = {"ridge": (1.0, 0.0), "elasticnet": (0.02, 0.15), "lasso": (0.5, 1.0)}


def _sql_linear_fits() -> str:
    z = "(lag_1 - (SELECT avg(lag_1) FROM trb)) / (SELECT stddev_pop(lag_1) FROM trb)"
    parts = []
    for name, (alpha, l1) in LINEAR_FITS.items():
        if l1 == 0:
            slope = f"sum(z * yc) / (count(*) + {alpha})"
        else:
            c = "sum(z * yc) / count(*)"
            slope = f"sign({c}) * greatest(abs({c}) - {alpha * l1}, 0.0) / (1 + {alpha * (1 - l1)})"
        parts.append(f"SELECT '{name}' AS model, count(*) AS n, round({slope}, 4) AS slope, round(any_value(my), 4) AS intercept FROM zy")
    return f"""WITH zy AS (SELECT {z} AS z, count - (SELECT avg(count) FROM trb) AS yc, (SELECT avg(count) FROM trb) AS my FROM trb)
               {' UNION ALL '.join(parts)}"""


@register("mod_02_03_linear_fits_one_feature", _ft_sql(f"SELECT * FROM ({_sql_linear_fits()})", _sql_train_base()))
def q_mod_02(spark, sf):
    from panelcast.operators.models import fit_linear

    train = train_a(spark, sf)
    n = train.count()
    rows = []
    for name, (alpha, l1) in LINEAR_FITS.items():
        m = fit_linear(train, ["lag_1"], [], "count", alpha, l1)
        rows.append((name, n, float(m.coef[0]), float(m.intercept)))
    return round_doubles(spark.createDataFrame(rows, "model string, n long, slope double, intercept double"), 4)


def _ridge_two_sql(src: str, folds: str, y: str, alpha: float) -> dict:
    """Ridge on lag_1 and roll4_mean per group of weeks in closed form: coefficients on the standardised columns."""
    return {
        "r2s": f"""SELECT f.fold, count(*) AS n, avg(lag_1) AS m1, stddev_pop(lag_1) AS s1, avg(roll4_mean) AS m2, stddev_pop(roll4_mean) AS s2,
                          avg({y}) AS my FROM {src} t JOIN {folds} f ON f.yearweek = t.yearweek AND f.role = 'train' GROUP BY f.fold""",
        "r2z": f"""SELECT f.fold, (lag_1 - m1) / s1 AS z1, (roll4_mean - m2) / s2 AS z2, {y} - my AS yc
                   FROM {src} t JOIN {folds} f ON f.yearweek = t.yearweek AND f.role = 'train' JOIN r2s ON r2s.fold = f.fold""",
        "r2g": f"""SELECT fold, sum(z1 * z1) + {alpha} AS a11, sum(z1 * z2) AS a12, sum(z2 * z2) + {alpha} AS a22, sum(z1 * yc) AS b1, sum(z2 * yc) AS b2
                   FROM r2z GROUP BY fold""",
        "r2w": """SELECT r2s.*, (b1 * a22 - b2 * a12) / (a11 * a22 - a12 * a12) AS w1, (b2 * a11 - b1 * a12) / (a11 * a22 - a12 * a12) AS w2
                  FROM r2g JOIN r2s USING (fold)""",
    }


def _sql_ridge_groups() -> str:
    d = _sql_train_base()
    d.update(Q.rolling_fold_ctes("trb", OOF_SPLITS, OOF_MIN_TRAIN, "gcut"))
    d["gfolds"] = "SELECT fold, yearweek, role FROM gcut UNION ALL SELECT DISTINCT -1, yearweek, 'train' FROM trb"
    d["gfolds"] = "SELECT CAST(fold AS INTEGER) AS fold, yearweek, role FROM (" + d["gfolds"] + ")"
    d.update(_ridge_two_sql("trb", "gfolds", "count", 1.0))
    return _ft_sql("SELECT fold, n, round(w1, 4) AS lag_1, round(w2, 4) AS roll4_mean, round(my, 4) AS intercept FROM r2w", d)


@register("mod_02_ridge_two_features_by_fold", _sql_ridge_groups())
def q_mod_02_groups(spark, sf):
    """Ridge of every fold and of all rows (fold -1) from one aggregation of sums per segment of weeks."""
    from panelcast.operators.linear import LinearModel
    from panelcast.operators.models import group_equations, group_preprocess

    train = train_a(spark, sf)
    weeks = SP.distinct_weeks(train)
    groups = {i: tr for i, (tr, _) in enumerate(SP.rolling_splits(weeks, OOF_SPLITS, OOF_MIN_TRAIN))} | {-1: weeks}
    pres, _ = group_preprocess(train, groups, ["lag_1", "roll4_mean"], [])
    rows = []
    for g, eq in group_equations(train, groups, pres).items():
        m = LinearModel.of(pres[g], eq, eq.solve(1.0))
        rows.append((g, int(eq.n), float(m.coef[0]), float(m.coef[1]), m.intercept))
    return round_doubles(spark.createDataFrame(rows, "fold int, n long, lag_1 double, roll4_mean double, intercept double"), 4)


def _sql_ridge_meta() -> str:
    d = _sql_oof_matrix()
    d["sv2"] = "SELECT * FROM mx WHERE y_true IS NOT NULL AND lag_1 IS NOT NULL AND roll4_mean IS NOT NULL"
    d.update(Q.rolling_fold_ctes("sv2", 2, 12, "mf2"))
    d.update(_ridge_two_sql("sv2", "mf2", "y_true", 1.0))
    return _ft_sql(f"""SELECT data_source, disease, county, t.yearweek,
                              round(greatest(my + w1 * (lag_1 - m1) / s1 + w2 * (roll4_mean - m2) / s2, 0.0), 4) AS y_pred
                       FROM sv2 t JOIN mf2 f ON f.yearweek = t.yearweek AND f.role = 'valid' JOIN r2w ON r2w.fold = f.fold""", d)


@register("cv_06_ridge_rolling_meta_oof", _sql_ridge_meta())
def q_cv_06_ridge(spark, sf):
    """Rolling evaluation of a regression combiner (COM-6): its out-of-fold predictions."""
    from panelcast.operators.stacking import meta_oof

    pred, kind = meta_oof(oof_matrix_a(spark, sf), ["lag_1", "roll4_mean"], "ridge", [*C.KEY_COLS, "yearweek"], OOF_SPLITS)
    if kind != "rolling_meta_oof":
        raise RuntimeError(kind)
    return round_doubles(pred, 4)


#: Pairs of columns for the non-negative fit; with the negated one the constraint is active.
NNLS_PAIRS = (("lag_1", "roll4_mean"), ("seasonal_naive", "negated"), ("negated", "roll4_mean"))


def _sql_nnls_pairs() -> str:
    d = _sql_metric_table()
    d["svn"] = "SELECT *, -lag_1 AS negated FROM sv"
    parts = []
    for a, b in NNLS_PAIRS:
        parts.append(f"""SELECT '{a}' AS a, '{b}' AS b, var_pop({a}) AS a11, covar_pop({a}, {b}) AS a12, var_pop({b}) AS a22, covar_pop({a}, y_true) AS b1,
                                covar_pop({b}, y_true) AS b2, avg({a}) AS m1, avg({b}) AS m2, avg(y_true) AS my FROM svn""")
    d["nn"] = " UNION ALL ".join(parts)
    d["nu"] = "SELECT *, (b1 * a22 - b2 * a12) / (a11 * a22 - a12 * a12) AS u1, (b2 * a11 - b1 * a12) / (a11 * a22 - a12 * a12) AS u2 FROM nn"
    one = "greatest(b1, 0) * greatest(b1, 0) / a11 >= greatest(b2, 0) * greatest(b2, 0) / a22"
    d["nw"] = f"""SELECT *, CASE WHEN u1 >= 0 AND u2 >= 0 THEN u1 WHEN {one} THEN greatest(b1 / a11, 0) ELSE 0 END AS w1,
                         CASE WHEN u1 >= 0 AND u2 >= 0 THEN u2 WHEN {one} THEN 0 ELSE greatest(b2 / a22, 0) END AS w2 FROM nu"""
    return _ft_sql("SELECT a, b, round(w1, 5) AS weight_a, round(w2, 5) AS weight_b, round(my - w1 * m1 - w2 * m2, 5) AS intercept FROM nw", d)


@register("com_10_nnls_two_models", _sql_nnls_pairs())
def q_com_10_pairs(spark, sf):
    from panelcast.operators.combine import complete_cases
    from panelcast.operators.stacking import fit_nnls

    valid = complete_cases(oof_matrix_a(spark, sf), BASE_MODELS).withColumn("negated", -F.col("lag_1"))
    fits = [(pair, fit_nnls(valid, list(pair))) for pair in NNLS_PAIRS]
    rows = [(*pair, float(f.coef[0]), float(f.coef[1]), f.intercept) for pair, f in fits]
    return round_doubles(spark.createDataFrame(rows, "a string, b string, weight_a double, weight_b double, intercept double"), 5)


@register("mod_01_category_levels", _ft_sql(
    """SELECT col AS feature, level, CAST(row_number() OVER (PARTITION BY col ORDER BY n DESC, level) AS INTEGER) AS place, n
       FROM (SELECT 'county' AS col, county AS level, count(*) AS n FROM trb GROUP BY county
             UNION ALL SELECT 'disease', disease, count(*) FROM trb GROUP BY disease)""", _sql_train_base()))
def q_mod_01_levels(spark, sf):
    """Levels of the categorical columns, most frequent (the mode) first, and the rows that their indicators mark."""
    from panelcast.operators.models import fit_preprocess

    train = train_a(spark, sf)
    pre = fit_preprocess(train, [], ["county", "disease"])
    names = pre.filled()[1]
    count = {}
    for i, c in enumerate(pre.categorical):
        for r in train.select(names[i].alias("v")).groupBy("v").count().collect():
            count[c, r["v"]] = r["count"]
    rows = [(c, v, k + 1, count[c, v]) for c in pre.categorical for k, v in enumerate(pre.levels[c])]
    return spark.createDataFrame(rows, "feature string, level string, place int, n long")


@register("com_10_nnls_one_model", _ft_sql(" UNION ALL ".join(
    f"""SELECT '{m}' AS base_model, round(greatest(covar_pop(y_true, {m}) / var_pop({m}), 0.0), 6) AS weight,
               round(avg(y_true) - greatest(covar_pop(y_true, {m}) / var_pop({m}), 0.0) * avg({m}), 6) AS intercept FROM sv"""
    for m in BASE_MODELS), _sql_metric_table()))
def q_com_10(spark, sf):
    from panelcast.operators.combine import complete_cases
    from panelcast.operators.stacking import fit_nnls

    valid = complete_cases(oof_matrix_a(spark, sf), BASE_MODELS)
    fits = [(m, fit_nnls(valid, [m])) for m in BASE_MODELS]
    rows = [(m, float(f.coef[0]), f.intercept) for m, f in fits]
    return round_doubles(spark.createDataFrame(rows, "base_model string, weight double, intercept double"))


@register("agg_17_feature_table_summary", _ft_sql(
    """SELECT data_source, count(DISTINCT disease) AS n_diseases, count(DISTINCT county) AS county_count,
              array_to_string(list_slice(list_sort(list(DISTINCT county)), 1, 30), ',') AS counties
       FROM ft GROUP BY data_source"""))
def q_agg_17(spark, sf):
    from panelcast.operators.reports import feature_table_summary

    return feature_table_summary(feature_a(spark, sf))


# ---------------------------------------------------------------------------
# Seasonal-naive holdout back-test (FIL-8, FIL-9, WIN-11, JOI-10, JOI-14, AGG-6, REP-8..10, COL-16)
# ---------------------------------------------------------------------------
def naive_holdout_a(spark, sf, panel: str = "county"):
    """Hold out the last 8 weeks up to the training cut; seasonal naive predicts them from the rest.

    ``panel`` = ``county`` uses the source panel as is, ``branch`` the EV rows collapsed to branches (PAN-3).
    """
    from panelcast.operators.panel import prepare_task, training_rows
    from panelcast.plans.forecast import split_holdout

    def build():
        if panel == "branch":
            ev, _ = prepare_task(feature_store_a(spark, sf), TV.SRC_A, "nhi_ev_branch", location_map(spark, sf),
                                 ev_disease=TV.TEST_EV_DISEASE, source_kind="nhi", check_empty=False)
            hist = training_rows(ev, train_cut(spark, sf))
        else:
            hist = history_a(spark, sf)
        split = split_holdout(hist, train_cut(spark, sf), HOLDOUT_N)
        train = FE.lag_rolling_features(split.base_train, "base").where(F.col("lag_1").isNotNull() & F.col("count").isNotNull())
        pred = OO.final_seasonal_naive(train, split.kept, out_col="y_pred")
        long = pred.join(split.actual("y_true"), [*C.KEY_COLS, "yearweek"], "left").select(
            *C.KEY_COLS, "yearweek", split.lead().alias("lead_week"), "y_true", "y_pred",
            F.lit("seasonal_naive").alias("model_name"), F.lit("holdout").alias("prediction_type"))
        return long, split

    return materialized(spark, sf, f"naive_holdout_{panel}", build)


_BRANCH_KEY = "replace(replace(replace(trim(f.county), '臺', '台'), ' ', ''), '　', '')"
SQL_BRANCH_HIST = {
    "cut": SQL_CUT,
    "lm": SQL_LOCMAP,
    "br": _collapse_sql(f"ft f JOIN lm ON lm.county_key = {_BRANCH_KEY} WHERE f.disease = '{TV.TEST_EV_DISEASE}'",
                        "lm.branch_t", rounded=False),
    "th": "SELECT * FROM br WHERE NOT is_future AND count IS NOT NULL AND yearweek <= (SELECT train_cut_week FROM cut)",
}


def _sql_naive_holdout(hist: dict | None = None) -> dict:
    d = dict(hist or SQL_HIST)
    d["hw"] = f"""SELECT yearweek, CAST(row_number() OVER (ORDER BY yearweek) AS INTEGER) AS lead_week
                  FROM (SELECT DISTINCT yearweek FROM th ORDER BY yearweek DESC LIMIT {HOLDOUT_N})"""
    d["bt"] = "SELECT * FROM th WHERE yearweek NOT IN (SELECT yearweek FROM hw)"
    d["hr"] = "SELECT * FROM th WHERE yearweek IN (SELECT yearweek FROM hw)"
    d["hk"] = f"""SELECT * EXCLUDE (_n) FROM (
                    SELECT * REPLACE (CAST(NULL AS DOUBLE) AS count, CAST(NULL AS DOUBLE) AS disease_rate),
                           CAST(row_number() OVER (PARTITION BY {Q.KEY} ORDER BY yearweek) AS INTEGER) AS h,
                           count(*) OVER (PARTITION BY {Q.KEY}) AS _n
                    FROM hr) WHERE _n = {HOLDOUT_N} AND h <= {HOLDOUT_N}"""
    d["trn"] = f"""SELECT * FROM (SELECT *, lag(count, 1) OVER (PARTITION BY {Q.KEY} ORDER BY yearweek) AS _l1 FROM bt)
                   WHERE _l1 IS NOT NULL AND count IS NOT NULL"""
    d["hkt"] = f"SELECT {Q.KEY}, yearweek, h FROM hk"
    d.update(Q.seasonal_naive_sql("trn", "hkt", Q.KEY))
    d["hlong"] = f"""SELECT p.data_source, p.disease, p.county, p.yearweek, w.lead_week, r.count AS y_true,
                            p.seasonal_naive AS y_pred, 'seasonal_naive' AS model_name, 'holdout' AS prediction_type
                     FROM sn_pred p JOIN hw w USING (yearweek)
                     LEFT JOIN hr r USING ({Q.KEY}, yearweek)"""
    d["hhit"] = Q.hit_cte("hlong", ["model_name"])
    d["hmet"] = Q.metric_select(["data_source", "model_name", "prediction_type"], "hhit", by_lead_week=True)
    return d


def naive_holdout_metric(spark, sf):
    long = naive_holdout_a(spark, sf)[0]
    return round_doubles(EV.metric_levels(long, ["data_source", "model_name", "prediction_type"], by_lead_week=True))


@register("fil_08_holdout_weeks", _ft_sql("SELECT * FROM hw", _sql_naive_holdout()))
def q_fil_08(spark, sf):
    split = naive_holdout_a(spark, sf)[1]
    return split.raw.select("yearweek", split.lead().alias("lead_week")).distinct()


@register("fil_09_holdout_train_split", _ft_sql(
    "SELECT 'train' AS part, count(*) AS n_rows, min(yearweek) AS min_week, max(yearweek) AS max_week FROM bt "
    "UNION ALL SELECT 'holdout', count(*), min(yearweek), max(yearweek) FROM hr", _sql_naive_holdout()))
def q_fil_09(spark, sf):
    split = naive_holdout_a(spark, sf)[1]

    def prof(df, name):
        return df.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n_rows"), F.min("yearweek").alias("min_week"),
                      F.max("yearweek").alias("max_week"))

    return prof(split.base_train, "train").unionByName(prof(split.raw, "holdout"))


@register("fil_10_rejected_series", _ft_sql(
    f"SELECT {Q.KEY}, count(*) AS rows FROM hr GROUP BY ALL HAVING count(*) <> {HOLDOUT_N}", _sql_naive_holdout()))
def q_fil_10_rejected(spark, sf):
    """Series without a row in every held-out week, which a back-test reports."""
    return naive_holdout_a(spark, sf)[1].rejected


def _holdout_run_sql(body: str) -> str:
    group = ["data_source", "model_task", "model_scope", "prediction_type", "model_layer", "model_name"]
    d = _sql_naive_holdout(SQL_TASK_HIST)
    d["rlong"] = f"SELECT *, '{RUN_TASK}' AS model_task, 'county' AS model_scope, 'base' AS model_layer FROM hlong"
    d["rhit"] = Q.hit_cte("rlong", ["model_name"])
    d["rmet"] = Q.metric_select(group, "rhit", by_lead_week=True)
    return _ft_sql(body, d)


@register("cv_08_run_naive_metrics", _holdout_run_sql(
    f"""SELECT *, 'weighted_average' AS meta_model, {_RUN_SETTINGS}, 'holdout_backtest' AS meta_eval_type,
               {HOLDOUT_N} AS holdout_weeks, (SELECT min(yearweek) FROM hw) AS holdout_start, (SELECT max(yearweek) FROM hw) AS holdout_end
        FROM rmet"""))
def q_cv_08_naive(spark, sf):
    """Metric rows of the back-test's naive model, as the run made them."""
    return round_doubles(holdout_run_a(spark, sf)["metric"].where("model_name = 'seasonal_naive'"))


@register("cv_08_holdout_rows", _holdout_run_sql(
    f"""SELECT {Q.KEY}, yearweek, lead_week, y_true AS actual_count, 'ensemble_weighted_average' AS model_name, 'ensemble' AS model_layer,
               '{RUN_TASK}' AS model_task, 'county' AS model_scope, {_RUN_SETTINGS} FROM hlong"""))
def q_cv_08_rows(spark, sf):
    """Rows, truth and settings of the back-test's predictions: all that does not hang on a fitted model."""
    return holdout_run_a(spark, sf)["predictions"].drop("forecast_count", "forecast_count_rounded")


def _holdout_feature_sql() -> str:
    d = _sql_naive_holdout()
    for m, p, nm in (("count", "", "cf"), ("source_total_count", "source_total_count_", "tf"), ("disease_rate", "disease_rate_", "rf")):
        d.update(Q.future_feature_ctes("bt", m, p, "base", HOLDOUT_N, nm))
    d["hkl"] = "SELECT * EXCLUDE (h), h AS lead_week FROM hk"
    names = Q.feature_names("base")
    body = f"""SELECT * REPLACE ({_round_cols([*FT_DOUBLES, *names])}) FROM
               (SELECT x.*, r.count AS actual_count FROM
                  (SELECT * FROM hkl JOIN cf USING ({Q.KEY}, lead_week) LEFT JOIN tf USING ({Q.KEY}, lead_week)
                                   LEFT JOIN rf USING ({Q.KEY}, lead_week)) x
                LEFT JOIN hr r USING ({Q.KEY}, yearweek))"""
    return _ft_sql(body, d)


@register("win_11_holdout_features", _holdout_feature_sql())
def q_win_11(spark, sf):
    split = naive_holdout_a(spark, sf)[1]
    feats = FE.future_features(split.base_train, split.kept, "base", HOLDOUT_N)
    return round_doubles(feats.join(split.actual("actual_count"), [*C.KEY_COLS, "yearweek"], "left"))


@register("agg_06_holdout_metric_levels", _ft_sql("SELECT * FROM hmet", _sql_naive_holdout()))
def q_agg_06(spark, sf):
    return naive_holdout_metric(spark, sf)


@register("rep_08_lead_week_summary", _ft_sql(
    """SELECT data_source, model_name, lead_week, n_obs, WAPE, MAE, RMSE, Pearson, HitRate, Bias
       FROM hmet WHERE metric_level = 'by_lead_week'""", _sql_naive_holdout()))
def q_rep_08(spark, sf):
    from panelcast.operators.reports import lead_week_summary

    return lead_week_summary(naive_holdout_metric(spark, sf))


@register("rep_10_holdout_leaderboard", _ft_sql("SELECT * FROM hmet WHERE metric_level = 'overall'", _sql_naive_holdout()))
def q_rep_10(spark, sf):
    from panelcast.operators.reports import holdout_leaderboard

    return holdout_leaderboard(naive_holdout_metric(spark, sf))


PLOT_WEEKS = 26


@register("rep_09_chart_series", _ft_sql(
    f"""SELECT coalesce(a.data_source, p.data_source) AS data_source, coalesce(a.disease, p.disease) AS disease,
               coalesce(a.county, p.county) AS county, coalesce(a.yearweek, p.yearweek) AS yearweek,
               a.actual_count, round(p.forecast_count, 6) AS forecast_count,
               translate(concat_ws('_', coalesce(a.data_source, p.data_source), coalesce(a.disease, p.disease),
                                   coalesce(a.county, p.county)), '/ ', '__') AS series_name,
               coalesce(a.yearweek, p.yearweek) >= (SELECT min(yearweek) FROM hw) AS in_holdout
        FROM (SELECT {Q.KEY}, yearweek, count AS actual_count FROM th
              WHERE yearweek >= (SELECT min(yearweek) FROM (SELECT DISTINCT yearweek FROM th ORDER BY yearweek DESC LIMIT {PLOT_WEEKS}))) a
        FULL JOIN (SELECT {Q.KEY}, yearweek, y_pred AS forecast_count FROM hlong
                   WHERE ({Q.KEY}) IN (SELECT ({Q.KEY}) FROM th
                        WHERE yearweek >= (SELECT min(yearweek) FROM (SELECT DISTINCT yearweek FROM th ORDER BY yearweek DESC LIMIT {PLOT_WEEKS})))) p
        USING ({Q.KEY}, yearweek)""", _sql_naive_holdout()))
def q_rep_09(spark, sf):
    from panelcast.operators.reports import chart_series

    long, split = naive_holdout_a(spark, sf)
    pred = long.select(*C.KEY_COLS, "yearweek", F.col("y_pred").alias("forecast_count"))
    return round_doubles(chart_series(history_a(spark, sf), pred, PLOT_WEEKS, C.KEY_COLS, split.weeks[0]))


@register("col_16_compact_predictions", _ft_sql(
    """SELECT data_source, 'base/seasonal_naive' AS model_method, disease, county, yearweek, lead_week,
              y_true AS actual_count, round(y_pred, 6) AS forecast_count,
              CAST(greatest(round_even(y_pred, 0), 0) AS BIGINT) AS forecast_count_rounded
       FROM hlong""", _sql_naive_holdout()))
def q_col_16(spark, sf):
    from panelcast.operators.reports import compact_predictions

    long = naive_holdout_a(spark, sf)[0]
    df = long.select(*C.KEY_COLS, "yearweek", "lead_week", F.col("y_true").alias("actual_count"),
                     F.col("y_pred").alias("forecast_count"), F.lit("default").alias("model_task"),
                     F.lit("base").alias("model_layer"), F.col("model_name"))
    return round_doubles(compact_predictions(df))


@register("set_06_base_predictions_long", _ft_sql(
    " UNION ALL ".join(f"SELECT {Q.KEY}, yearweek, '{m}' AS base_model, round({m}, 6) + 0.0 AS y_pred FROM mx" for m in BASE_MODELS),
    _sql_oof_matrix()))
def q_set_06(spark, sf):
    long = EV.to_long(oof_matrix_a(spark, sf), [*C.KEY_COLS, "yearweek"], BASE_MODELS, name_col="base_model", drop_missing=False)
    return round_doubles(long)


# ---------------------------------------------------------------------------
# Location dimension (SRC-6, SET-5, AGG-3)
# ---------------------------------------------------------------------------
def _sql_strip(c: str) -> str:
    return rf"regexp_replace({c}, '^[\s　]+|[\s　]+$', '', 'g')"


def _sql_place_key(c: str) -> str:
    return f"replace(replace(replace({_sql_strip(c)}, '臺', '台'), ' ', ''), '　', '')"


SQL_LOC_SCAN = "SELECT DISTINCT old_name, new_name, branch_t FROM dim_location_raw WHERE branch_t IS NOT NULL"
SQL_LOC_EXPANDED = " UNION ALL ".join(
    f"""SELECT {_sql_place_key(c)} AS county_key, coalesce({_sql_strip("new_name")}, 'None') AS new_name, {_sql_strip("branch_t")} AS branch_t
        FROM ({SQL_LOC_SCAN}) WHERE {_sql_strip(c)} <> ''""" for c in ("old_name", "new_name"))


def expanded_locations(spark, sf):
    from panelcast.operators.locations import expand_locations, scan_locations

    return expand_locations(scan_locations(TV.dim_location_raw(TV.Tables(spark, sf))))


@register("set_05_location_expansion", TV.with_views(SQL_LOC_EXPANDED, "dim_location_raw"))
def q_set_05(spark, sf):
    return expanded_locations(spark, sf)


@register("agg_03_location_conflicts", TV.with_views(
    f"SELECT county_key, count(DISTINCT branch_t) AS n_branch FROM ({SQL_LOC_EXPANDED}) GROUP BY county_key HAVING count(DISTINCT branch_t) > 1",
    "dim_location_raw"))
def q_agg_03(spark, sf):
    from panelcast.operators.locations import location_conflicts

    return location_conflicts(expanded_locations(spark, sf))


@register("src_06_location_scan", TV.with_views(SQL_LOC_SCAN, "dim_location_raw"))
def q_src_06(spark, sf):
    from panelcast.operators.locations import scan_locations

    return scan_locations(TV.dim_location_raw(TV.Tables(spark, sf)))


@register("joi_08_unmapped_places", TV.with_views(
    f"SELECT DISTINCT county FROM ({SQL_TARGET_A}) WHERE ends_with(county, '1')", "panel_a"))
def q_joi_08(spark, sf):
    """Places that a location map without them does not know."""
    from panelcast.operators.locations import unmapped_places

    return unmapped_places(target_a(spark, sf), location_map(spark, sf).where(~F.col("county_key").endswith("1")))


# ---------------------------------------------------------------------------
# Named-parameter query, correlations, seasonality (SRC-10, AGG-10, SCA-2, SCA-3)
# ---------------------------------------------------------------------------
@register("src_10_named_parameter_query", TV.with_views(
    f"""SELECT county, disease, count(*) AS weeks, sum(count) AS total FROM ({SQL_TARGET_A})
        WHERE yearweek BETWEEN 199801 AND 199952 GROUP BY county, disease""", "panel_a"))
def q_src_10(spark, sf):
    return SC.read_sql(spark, """SELECT county, disease, count(*) AS weeks, sum(count) AS total FROM {panel}
                                 WHERE yearweek BETWEEN :lo AND :hi GROUP BY county, disease""",
                       {"lo": 199801, "hi": 199952}, panel=target_a(spark, sf))


CORR_COLS = ["lag_1", "lag_2", "lag_4", "roll4_mean", "roll8_mean"]


@register("agg_10_feature_correlations", _ft_sql(" UNION ALL ".join(
    f"""SELECT '{a}' AS feature_a, '{b}' AS feature_b,
               round(CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0
                          THEN covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})) END, 6) + 0.0 AS corr FROM imp"""
    for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:]), {
        **_sql_train_base(),
        "med": "SELECT " + ", ".join(f"median({c}) AS m_{c}" for c in CORR_COLS) + " FROM trb",
        "imp": "SELECT " + ", ".join(f"coalesce({c}, (SELECT m_{c} FROM med)) AS {c}" for c in CORR_COLS) + " FROM trb"}))
def q_agg_10(spark, sf):
    from panelcast.operators.selection import column_medians, impute, pair_correlations

    tr = train_a(spark, sf).select(*CORR_COLS)
    return round_doubles(pair_correlations(impute(tr, column_medians(tr, CORR_COLS)), CORR_COLS))


@register("sca_02_week_seasonality", _ft_sql(
    f"""SELECT {Q.KEY}, yearweek, CAST(yearweek // 100 AS INTEGER) AS year, CAST(yearweek % 100 AS INTEGER) AS week,
               round(sin(2 * pi() * (yearweek % 100) / 52), 6) + 0.0 AS week_sin,
               round(cos(2 * pi() * (yearweek % 100) / 52), 6) + 0.0 AS week_cos,
               round(lag(count, 1) OVER (PARTITION BY {Q.KEY} ORDER BY yearweek), 6) AS lag_1
        FROM th""", SQL_HIST))
def q_sca_02(spark, sf):
    h = history_a(spark, sf).select(*C.KEY_COLS, "yearweek", "count",
                                    (F.col("yearweek") / 100).cast("int").alias("year"),
                                    (F.col("yearweek") % 100).cast("int").alias("week"))
    f = FE.lag_rolling_features(h, "base")
    return round_doubles(f.select(*C.KEY_COLS, "yearweek", "year", "week", "week_sin", "week_cos", "lag_1"))


@register("win_01_07_lag_rolling_medium_src_b", TV.with_views(
    f"""SELECT * REPLACE ({_round_cols(Q.feature_names('medium', ('count',)))})
        FROM (SELECT *, {', '.join(Q.feature_exprs('medium', ('count',)))} FROM ({SQL_TARGET_B}))""", "panel_b"))
def q_win_src_b(spark, sf):
    return round_doubles(FE.lag_rolling_features(target_b(spark, sf), "medium"))



@register("win_01_07_features_on_offshore_panel", _ft_sql(
    f"""SELECT * REPLACE ({_round_cols(['count', 'source_total_count', 'disease_rate', 'airtemperature_avg', 'rain_days',
                                         'cnt', 'voc', 'eve', 'ev_period', 'di_period', 'covid', *Q.feature_names('base')])})
        FROM (SELECT *, {', '.join(Q.feature_exprs('base'))} FROM off_hist)""", {
        "cut": SQL_CUT,
        "off": _collapse_sql(f"ft WHERE disease <> '{TV.TEST_EV_DISEASE}'",
                             f"CASE WHEN trim(county) IN ({_OFFSHORE_SQL}) THEN '{C.OFFSHORE_LABEL}' ELSE trim(county) END",
                             rounded=False),
        "off_hist": "SELECT * FROM off WHERE NOT is_future AND count IS NOT NULL AND yearweek <= (SELECT train_cut_week FROM cut)"}))
def q_win_offshore(spark, sf):
    """PAN-4 then FIL-3 then WIN-1..7: features of the task panel after the offshore collapse."""
    from panelcast.operators.panel import prepare_task, training_rows

    panel, _ = prepare_task(feature_store_a(spark, sf), TV.SRC_A, "nhi_non_ev_county", ev_disease=TV.TEST_EV_DISEASE,
                            offshore=TV.TEST_OFFSHORE, source_kind="nhi", check_empty=False)
    return round_doubles(FE.lag_rolling_features(training_rows(panel, train_cut(spark, sf)), "base"))



@register("agg_06_branch_holdout_metric_levels", _ft_sql("SELECT * FROM hmet", _sql_naive_holdout(SQL_BRANCH_HIST),
                                                         views=("dim_location",)))
def q_agg_06_branch(spark, sf):
    """PAN-3 then CV-8 with the seasonal naive: back-test metrics of the branch-level EV panel."""
    long = naive_holdout_a(spark, sf, "branch")[0]
    return round_doubles(EV.metric_levels(long, ["data_source", "model_name", "prediction_type"], by_lead_week=True))


# ---------------------------------------------------------------------------
# Missing predictions, selection, folds, task routing (COM-5, MOD-11, SEL-2, CV-1, CV-2, PAN-6, COL-12, MOD-9)
# ---------------------------------------------------------------------------
def gappy_matrix_a(spark, sf) -> DataFrame:
    """The prediction matrix with gaps: one model lacks every fifth week, one has no prediction at all."""
    return oof_matrix_a(spark, sf).withColumns({
        "lag_1": F.when(F.col("yearweek") % 5 != 0, F.col("lag_1")), "roll4_mean": F.lit(None).cast("double")})


def _sql_gappy(method: str = META_METHOD) -> dict:
    return {**_sql_metric_table(method),
            "gap": "SELECT * REPLACE (CASE WHEN yearweek % 5 <> 0 THEN lag_1 END AS lag_1, CAST(NULL AS DOUBLE) AS roll4_mean) FROM mx"}


def _sql_filled(c: str) -> str:
    return f"coalesce({c}, (SELECT median({c}) FROM gap), 0.0)"


@register("mod_11_imputed_predictions", _ft_sql(
    f"SELECT {Q.KEY}, yearweek, y_true, {', '.join(f'round({_sql_filled(c)}, 6) AS {c}' for c in BASE_MODELS)} FROM gap", _sql_gappy()))
def q_mod_11(spark, sf):
    from panelcast.plans.forecast import impute_predictions

    return round_doubles(impute_predictions(gappy_matrix_a(spark, sf), BASE_MODELS))


def _sql_combined_with_gaps() -> str:
    d = _sql_gappy()
    d["afit"] = " UNION ALL ".join(
        f"SELECT 0 AS fold, y_true, {m} AS y_pred, '{m}' AS model_name, {i} AS _model_pos FROM sv" for i, m in enumerate(BASE_MODELS))
    d.update(Q.rule_weight_ctes("afit", META_METHOD, C.DEFAULT_ENSEMBLE_TOPK, "aw"))
    total = " + ".join(f"(SELECT weight FROM aw WHERE model_name = '{m}') * {_sql_filled(m)}" for m in BASE_MODELS)
    return _ft_sql(f"SELECT {Q.KEY}, yearweek, round(greatest({total}, 0.0), 6) AS y_pred FROM gap", d)


@register("com_05_combined_with_gaps", _sql_combined_with_gaps())
def q_com_05(spark, sf):
    """COM-5 + COM-11: a weighted average over predictions with gaps, which take their column's median, then 0."""
    from panelcast.operators.stacking import fit_combiner, predict_combiner

    meta = fit_combiner(oof_matrix_a(spark, sf), BASE_MODELS, META_METHOD)
    return round_doubles(predict_combiner(meta, gappy_matrix_a(spark, sf), [*C.KEY_COLS, "yearweek"]))


@register("fil_12_models_with_predictions", _ft_sql(
    " UNION ALL ".join(f"SELECT '{m}' AS model_name FROM gap HAVING count({m}) > 0" for m in BASE_MODELS), _sql_gappy()))
def q_fil_12(spark, sf):
    from panelcast.operators.combine import drop_empty_models

    used = drop_empty_models(gappy_matrix_a(spark, sf), BASE_MODELS)
    return spark.createDataFrame([(m,) for m in used], "model_name string")


#: Features for the filter, with a linear twin of one and a constant among them.
FILTER_COLS = [*PROFILE_COLS, "lag_8_twin", "flat"]


def _sql_filter_decision() -> str:
    d = _sql_train_base()
    cols = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in PROFILE_COLS)
    d["few"] = f"SELECT row_number() OVER () AS rid, {cols}, 2 * lag_8 + 1 AS lag_8_twin, CAST(1 AS DOUBLE) AS flat FROM trb"
    ranked = [c for c in FILTER_COLS if c in C.MANDATORY_NUMERIC_FEATURES] + [c for c in FILTER_COLS if c not in C.MANDATORY_NUMERIC_FEATURES]
    d["lng"] = " UNION ALL ".join(
        f"SELECT rid, '{c}' AS feature, {ranked.index(c)} AS place, {str(c in C.MANDATORY_NUMERIC_FEATURES).lower()} AS must, {c} AS v FROM few" for c in FILTER_COLS)
    d["prof"] = """SELECT feature, place, must, avg(CASE WHEN v IS NULL THEN 1.0 ELSE 0.0 END) AS missing, count(DISTINCT v) AS n_unique, median(v) AS med
                   FROM lng GROUP BY ALL"""
    d["full_"] = "SELECT l.rid, l.feature, p.place, coalesce(l.v, p.med) AS v FROM lng l JOIN prof p USING (feature) WHERE p.missing < 1"
    d["cand"] = """SELECT p.* FROM prof p JOIN (SELECT feature, var_pop(v) AS spread FROM full_ GROUP BY feature) USING (feature)
                   WHERE must OR (missing <= 0.9 AND n_unique > 1 AND spread > 0)"""
    d["twin"] = """SELECT DISTINCT fb AS feature FROM (
                     SELECT a.feature AS fa, b.feature AS fb, abs(corr(a.v, b.v)) AS r
                     FROM full_ a JOIN full_ b ON a.rid = b.rid AND a.place < b.place
                     WHERE a.feature IN (SELECT feature FROM cand) AND b.feature IN (SELECT feature FROM cand) GROUP BY ALL) WHERE r > 0.98"""
    return _ft_sql("""SELECT feature, feature IN (SELECT feature FROM cand WHERE must OR feature NOT IN (SELECT feature FROM twin)) AS selected,
                             'filter' AS selection_stage FROM prof""", d)


@register("sel_02_filter_decision", _sql_filter_decision())
def q_sel_02(spark, sf):
    """SEL-1 + SEL-2: which features the filter keeps."""
    from panelcast.operators.selection import select_features

    train = train_a(spark, sf).withColumns({"lag_8_twin": 2 * F.col("lag_8") + 1, "flat": F.lit(1.0)})
    return select_features(train, FILTER_COLS, "filter").report.select("feature", "selected", "selection_stage")


# folds with too short a history are dropped, the others counted from 0
@register("cv_01_rolling_folds", _ft_sql("SELECT CAST(fold - min(fold) OVER () AS INTEGER) AS fold, yearweek, role FROM folds", {
    **_sql_oof_matrix(), **Q.rolling_fold_ctes("trn", C.RUN_MODES["full"].folds.n_splits, C.RUN_MODES["full"].folds.min_train_weeks, "folds")}))
def q_cv_01(spark, sf):
    """The folds of a full run."""
    f = C.RUN_MODES["full"].folds
    return SP.fold_table(spark, SP.rolling_splits(SP.distinct_weeks(train_a(spark, sf)), f.n_splits, f.min_train_weeks))


@register("cv_02_tuning_folds", _ft_sql("SELECT CAST(fold AS INTEGER) AS fold, yearweek, role FROM folds", {
    **_sql_oof_matrix(), **Q.rolling_fold_ctes("trn", 3, 52, "folds")}))
def q_cv_02(spark, sf):
    """The folds that grid search tunes on."""
    return SP.fold_table(spark, SP.inner_splits(SP.distinct_weeks(train_a(spark, sf)), 3))


#: The test panels as sources of known names.
TASK_SOURCES = {TV.SRC_A: "nhi_er", TV.SRC_B: "rods"}


@register("pan_06_task_models", TV.with_views(
    f"""SELECT p.data_source, t.model_task, t.model_scope, t.is_rods_ev_national, t.is_offshore_collapsed, t.n_models, p.n_rows
        FROM (SELECT 'nhi_er' AS data_source, count(*) AS n_rows FROM ({SQL_TARGET_A})
              UNION ALL SELECT 'rods', count(*) FROM ({SQL_TARGET_B})) p
        JOIN (VALUES ('nhi_er', 'nhi_ev_branch', 'branch', false, false, 7),
                     ('nhi_er', 'nhi_non_ev_county', 'county', false, true, 6),
                     ('rods', 'rods_ev_national', 'national', true, false, 4),
                     ('rods', 'rods_non_ev', 'county', false, true, 6))
             t(data_source, model_task, model_scope, is_rods_ev_national, is_offshore_collapsed, n_models) USING (data_source)""",
    "panel_a", "panel_b"))
def q_pan_06(spark, sf):
    """PAN-6 + COL-12 + MOD-8/9: the tasks of each source in the data, their flags and how many models a full run fits."""
    from panelcast.operators.models import resolve_allowed_registry

    name = F.create_map(*[F.lit(x) for pair in TASK_SOURCES.items() for x in pair])
    both = target_a(spark, sf).select("data_source").unionByName(target_b(spark, sf).select("data_source"))
    found = both.groupBy(name[F.col("data_source")].alias("data_source")).agg(F.count(F.lit(1)).alias("n_rows"))
    rows = []
    for t in C.expand_model_tasks([r.data_source for r in found.select("data_source").collect()]):
        m = C.task_metadata(t["model_task"])
        rows.append((t["data_source"], t["model_task"], m["model_scope"], m["is_rods_ev_national"], m["is_offshore_collapsed"],
                     len(resolve_allowed_registry(t["model_task"], C.RUN_MODES["full"].models))))
    tasks = spark.createDataFrame(rows, "data_source string, model_task string, model_scope string, is_rods_ev_national boolean, "
                                        "is_offshore_collapsed boolean, n_models int")
    return found.join(F.broadcast(tasks), "data_source")

"""Window features over each series (WIN-1..12, SCA-2).

A series is KEY_COLS ordered by yearweek. Every frame is row-based: a lag is
"k rows back", not "k calendar weeks back", so gaps are jumped over. All
expressions of one window spec are emitted in a single ``select`` so Spark
plans one exchange and one sort for the whole feature block. A series holds
at most one row per week, so a window partition is bounded by the calendar
length whatever the data volume.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast import config as C

MEASURES = (("count", ""), ("source_total_count", "source_total_count_"), ("disease_rate", "disease_rate_"))


def _cfg(feature_set: str) -> dict:
    if feature_set not in C.FEATURE_SETS:
        raise ValueError(f"no feature set is called {feature_set!r}")
    return C.FEATURE_SETS[feature_set]


def _ratio_change(base: F.Column, cmp: F.Column) -> F.Column:
    """WIN-5: (base - cmp) / cmp, NULL when cmp is 0 or NULL."""
    return F.try_divide(base - cmp, F.when(cmp != 0, cmp))


def season_columns(df: DataFrame) -> list[F.Column]:
    """SCA-2: week-of-year seasonality, only when the panel carries a ``week`` column."""
    if "week" not in df.columns:
        return []
    ang = F.lit(2 * math.pi) * F.col("week").cast("double") / 52
    return [F.sin(ang).alias("week_sin"), F.cos(ang).alias("week_cos")]


def lag_rolling_features(df: DataFrame, feature_set: str, key_cols=C.KEY_COLS, time_col: str = "yearweek") -> DataFrame:
    """WIN-1..7: lags, shifted rolling mean/std, diff and growth on count; lags and rolls on total and rate.

    Rolling statistics are frame aggregates over the w rows before the current
    one; NULLs are skipped, the mean needs one value, the sample std two. All
    expressions share one partitioning and order, so Spark plans one exchange
    and one sort for them.
    """
    cfg = _cfg(feature_set)
    w = Window.partitionBy(*key_cols).orderBy(time_col)
    names = feature_names(df, feature_set)
    made = dict(zip(("week_sin", "week_cos"), season_columns(df)))
    for measure, prefix in MEASURES:
        if measure not in df.columns:
            continue
        m = F.col(measure)
        for k in cfg["lags"]:
            made[f"{prefix}lag_{k}"] = F.lag(m, k).over(w)
        for win in cfg["rolling_windows"]:
            frame = w.rowsBetween(-win, -1)
            made[f"{prefix}roll{win}_mean"] = F.avg(m.cast("double")).over(frame)
            made[f"{prefix}roll{win}_std"] = F.stddev_samp(m.cast("double")).over(frame)
        if measure == "count":
            last = F.lag(m, 1).over(w)
            for k in cfg["diff_lags"]:
                made[f"diff_{k}"] = last - F.lag(m, k + 1).over(w)
            for k in cfg["growth_lags"]:
                made[f"growth_{k}"] = _ratio_change(last, F.lag(m, k + 1).over(w))
    return df.select(*[c for c in df.columns if c not in names], *[made[n].alias(n) for n in names])


def feature_names(df: DataFrame, feature_set: str) -> list[str]:
    """Names produced by ``lag_rolling_features`` for this input."""
    cfg = _cfg(feature_set)
    out = ["week_sin", "week_cos"] if "week" in df.columns else []
    for measure, prefix in MEASURES:
        if measure not in df.columns:
            continue
        out += [f"{prefix}lag_{k}" for k in cfg["lags"]]
        for win in cfg["rolling_windows"]:
            out += [f"{prefix}roll{win}_mean", f"{prefix}roll{win}_std"]
        if measure == "count":
            out += [f"diff_{k}" for k in cfg["diff_lags"]] + [f"growth_{k}" for k in cfg["growth_lags"]]
    return out


def feature_columns(df: DataFrame, exog_cols) -> tuple[list[str], list[str], list[str]]:
    """COL-9: engineered columns by prefix + exogenous columns; returns (features, numeric, categorical)."""
    prefixes = ("lag_", "roll", "diff_", "growth_", "source_total_count_lag_", "source_total_count_roll",
                "disease_rate_lag_", "disease_rate_roll")
    eng = [c for c in df.columns if c.startswith(prefixes) or c in ("week_sin", "week_cos")]
    numeric = list(dict.fromkeys(eng + [c for c in exog_cols if c in df.columns]))
    categorical = [c for c in C.CATEGORICAL_COLS if c in df.columns]
    return categorical + numeric, numeric, categorical


# ---------------------------------------------------------------------------
# WIN-10 / WIN-11: features of the future rows.
# ---------------------------------------------------------------------------
def future_features(history: DataFrame, future: DataFrame, feature_set: str, horizon: int,
                    key_cols=C.KEY_COLS, zero_std: bool = True) -> DataFrame:
    """WIN-10: features of the first ``horizon`` future rows of each series with history.

    ``future`` must carry ``lead_week`` (1..horizon, see ``complete_horizon``).
    The count history is never empty here (training rows have a count); total
    and rate features are NULL when their history is empty.

    The measures are melted, so one pass serves all of them: each measure's
    history is compacted (NULLs removed), its last value carried ``horizon - 1``
    rows on, and the feature of step h is the trailing-frame value at position
    n + h - 1. Equal to extending the list one step at a time, without a loop.
    Rows are dealt by series once; windows and the way back to one row per step
    reuse that.
    """
    cfg = _cfg(feature_set)
    keys = list(key_cols)
    measures = [(m, p) for m, p in MEASURES if m in history.columns]
    need = max(cfg["lags"] + cfg["rolling_windows"] + [k + 1 for k in cfg["diff_lags"] + cfg["growth_lags"]] + [1])
    long = history.select(*keys, "yearweek", *[F.col(m).cast("double").alias(m) for m, _ in measures]).unpivot(
        [*keys, "yearweek"], [m for m, _ in measures], "_m", "_v").where(F.col("_v").isNotNull()).repartition(*keys)
    series = Window.partitionBy(*keys, "_m")
    seq = (
        long.withColumn("_pos", F.row_number().over(series.orderBy("yearweek")))
        .withColumn("_n", F.count(F.lit(1)).over(series))
        .where(F.col("_pos") > F.col("_n") - need)
    )
    places = F.when(F.col("_pos") == F.col("_n"), F.sequence(F.col("_n"), F.col("_n") + horizon - 1)).otherwise(
        F.array(F.col("_pos").cast("long")))
    ext = seq.select(*keys, "_m", "_v", "_n", F.explode(places).alias("_pos"))
    w = series.orderBy("_pos")
    v = F.col("_v")
    made = {f"lag_{k}": F.lag(v, k - 1).over(w) if k > 1 else v for k in cfg["lags"]}
    for win in cfg["rolling_windows"]:
        frame = w.rowsBetween(-(win - 1), 0)
        std = F.stddev_samp(v).over(frame)
        made[f"roll{win}_mean"] = F.avg(v).over(frame)
        made[f"roll{win}_std"] = F.coalesce(std, F.lit(0.0)) if zero_std else std
    for k in cfg["diff_lags"]:
        made[f"diff_{k}"] = v - F.lag(v, k).over(w)
    for k in cfg["growth_lags"]:
        made[f"growth_{k}"] = _ratio_change(v, F.lag(v, k).over(w))
    steps = ext.select(*keys, "_m", "_n", "_pos", *[e.alias(f"_f_{n}") for n, e in made.items()]).where(
        F.col("_pos") >= F.col("_n")).withColumn("lead_week", (F.col("_pos") - F.col("_n") + 1).cast("int"))
    names = {}
    for m, prefix in measures:
        for n in made:
            if m == "count" or not n.startswith(("diff_", "growth_")):
                names[f"{prefix}{n}"] = F.max(F.when(F.col("_m") == m, F.col(f"_f_{n}")))
    feats = steps.groupBy(*keys, "lead_week").agg(
        F.max(F.col("_m") == "count").alias("_counted"), *[e.alias(n) for n, e in names.items()]
    ).where("_counted").drop("_counted")
    out = future.drop(*[c for c in names if c in future.columns]).join(feats, [*keys, "lead_week"])
    season = season_columns(out)
    if season:
        out = out.select("*", *season)
    return out


def lead_week(df: DataFrame, key_cols=C.KEY_COLS, time_col: str = "yearweek") -> DataFrame:
    """WIN-9: rank of the row's week inside its series."""
    w = Window.partitionBy(*key_cols).orderBy(time_col)
    return df.withColumn("lead_week", F.row_number().over(w))


def directional_hit(df: DataFrame, key_cols, time_col: str = "yearweek", y_true: str = "y_true",
                    y_pred: str = "y_pred", out: str = "_hit") -> DataFrame:
    """WIN-8: 1.0 when the step-to-step direction of truth and prediction agree, NULL on a series' first row."""
    w = Window.partitionBy(*key_cols).orderBy(time_col)
    td = F.col(y_true) - F.lag(y_true, 1).over(w)
    pdiff = F.col(y_pred) - F.lag(y_pred, 1).over(w)
    hit = F.when(td.isNotNull() & pdiff.isNotNull(), (F.signum(td) == F.signum(pdiff)).cast("double"))
    return df.withColumn(out, hit)


# ---------------------------------------------------------------------------
# WIN-12: seasonal naive.
# ---------------------------------------------------------------------------
def seasonal_naive(train: DataFrame, targets: DataFrame, group_cols, value_col: str = "count",
                   season: int = C.SEASON_LENGTH, out_col: str = "seasonal_naive") -> DataFrame:
    """Seasonal-naive prediction of step ``h`` for each target row.

    ``train``: group_cols + yearweek + value; ``targets``: group_cols + ``h`` (1-based step).
    Step h takes the value ``season`` positions back in the history extended by
    its own predictions; with fewer than ``season`` values it falls back to the
    mean of the last ``season`` values (0.0 for an empty history). Closed form:
    idx = n + h - 1 - season, lowered by whole seasons until it is inside the
    history. Groups without training rows get no prediction (inner join).
    """
    wk = Window.partitionBy(*group_cols)
    vals = (
        train.where(F.col(value_col).isNotNull())
        .select(*group_cols, "yearweek", F.col(value_col).cast("double").alias("_y"))
        .withColumn("_pos", F.row_number().over(wk.orderBy("yearweek")))
        .withColumn("_n", F.count(F.lit(1)).over(wk))
    )
    stats = vals.groupBy(*group_cols).agg(
        F.max("_n").alias("_n"),
        F.coalesce(F.avg(F.when(F.col("_pos") > F.col("_n") - season, F.col("_y"))), F.lit(0.0)).alias("_fallback"),
    )
    idx0 = F.col("_n") + F.col("h") - 1 - season
    over = idx0 - F.col("_n") + 1
    idx = F.when(idx0 >= F.col("_n"), idx0 - season * F.ceil(over / season)).otherwise(idx0)
    t = targets.join(stats, list(group_cols), "inner").withColumn("_idx", idx.cast("long"))
    look = vals.select(*group_cols, (F.col("_pos") - 1).cast("long").alias("_idx"), "_y")
    t = t.join(look, [*group_cols, "_idx"], "left")
    pred = F.when(F.col("_idx") < 0, F.col("_fallback")).otherwise(F.col("_y"))
    return t.withColumn(out_col, pred).drop("_n", "_fallback", "_idx", "_y")

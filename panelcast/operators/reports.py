"""Report frames over the metric and prediction tables (COL-14..17, FIL-14, SRT-2/3/4/8, AGG-13, AGG-15, JOI-11, JOI-16, REP-5..10, SCA-8, SCA-13)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRIC_OUTPUT_COLS = [
    "data_source", "model_method", "metric_level", "MAE", "RMSE", "MAPE", "sMAPE", "WAPE", "Bias", "Pearson",
    "HitRate", "y_true_sum", "y_pred_sum", "y_true_mean", "y_pred_mean", "disease", "county", "lead_week",
]
PREDICTION_OUTPUT_COLS = [
    "data_source", "model_method", "disease", "county", "yearweek", "lead_week", "actual_count", "forecast_count",
    "forecast_count_rounded",
]
BREAKDOWN_LEVELS = ("by_disease", "by_county", "by_disease_county", "by_lead_week")
_INVALID = ("", "nan", "None", "NaN", "<NA>")


def clean_text(df: DataFrame, col: str) -> F.Column:
    """COL-14 helper: text, with the usual missing-value spellings turned into NULL."""
    if col not in df.columns:
        return F.lit(None).cast("string")
    s = F.col(col).cast("string")
    return F.when(~s.isin(*_INVALID), s)


def model_method(df: DataFrame) -> F.Column:
    """COL-14: ``task/layer/name``; task omitted when missing or ``default``, layer omitted when missing."""
    task = clean_text(df, "model_task")
    layer = clean_text(df, "model_layer")
    name = F.coalesce(clean_text(df, "model_name"), clean_text(df, "base_model"), F.lit("unknown"))
    return F.concat_ws("/", F.when(task != "default", task), layer, name)


def rounded_count(col: str = "forecast_count", missing_as_zero: bool = False) -> F.Column:
    """SCA-8: round half to even, clip at 0, integer.

    Forecast outputs treat a missing value as 0; the compact projection (COL-16) keeps it missing.
    """
    c = F.col(col)
    if missing_as_zero:
        return F.greatest(F.rint(F.coalesce(c, F.lit(0.0))), F.lit(0.0)).cast("long")
    return F.when(c.isNotNull(), F.greatest(F.rint(c), F.lit(0.0)).cast("long"))


def compact_metrics(df: DataFrame) -> DataFrame:
    """COL-15: label + disease/county filled with ALL + the fixed output columns."""
    out = df.withColumn("model_method", model_method(df))
    for c in ("disease", "county"):
        out = out.withColumn(c, F.coalesce(F.col(c).cast("string"), F.lit("ALL")) if c in df.columns else F.lit("ALL"))
    return out.select(*[c for c in METRIC_OUTPUT_COLS if c in out.columns])


def compact_predictions(df: DataFrame) -> DataFrame:
    """COL-16: label, blanks for missing disease/county, NULL actuals when absent, rounded forecast when absent."""
    out = df.withColumn("model_method", model_method(df))
    for c in ("disease", "county"):
        out = out.withColumn(c, F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit(""))
    if "actual_count" not in out.columns:
        out = out.withColumn("actual_count", F.lit(None).cast("double"))
    if "forecast_count_rounded" not in out.columns and "forecast_count" in out.columns:
        out = out.withColumn("forecast_count_rounded", rounded_count("forecast_count"))
    return out.select(*[c for c in PREDICTION_OUTPUT_COLS if c in out.columns])


def leaderboard(metric: DataFrame) -> DataFrame:
    """REP-5: overall rows by source, task and WAPE (missing WAPE last)."""
    overall = metric.where(F.col("metric_level") == "overall")
    keys = [c for c in ("data_source", "model_task") if c in metric.columns]
    ordered = overall.orderBy(*keys, F.col("WAPE").asc_nulls_last(), F.col("model_name"))
    return compact_metrics(ordered)


def breakdown(metric: DataFrame, top_n: int = 200) -> DataFrame:
    """REP-6: the ``top_n`` worst breakdown rows by WAPE (missing WAPE last; ties by label and group)."""
    rows = compact_metrics(metric.where(F.col("metric_level").isin(*BREAKDOWN_LEVELS)))
    return rows.orderBy(F.col("WAPE").desc_nulls_last(), "model_method", "metric_level", "disease", "county").limit(top_n)


def best_base(metric: DataFrame, group_cols=("data_source", "model_task", "model_scope")) -> DataFrame:
    """AGG-13: the base model with the smallest overall WAPE per task (ties by name)."""
    g = [c for c in group_cols if c in metric.columns]
    base = metric.where((F.col("metric_level") == "overall") & (F.col("model_layer") == "base") & F.col("WAPE").isNotNull())
    best = base.groupBy(*g).agg(F.min(F.struct("WAPE", "model_name")).alias("_b"))
    return best.select(*g, F.col("_b.model_name").alias("best_base_model"), F.col("_b.WAPE").alias("best_base_wape"))


def meta_model_comparison(metric: DataFrame) -> DataFrame:
    """REP-7 (+ JOI-11): each combiner's overall WAPE against the best base model of its task."""
    g = [c for c in ("data_source", "model_task", "model_scope") if c in metric.columns]
    comb = metric.where((F.col("metric_level") == "overall") & F.col("model_layer").isin("stacking", "ensemble"))
    keep = [c for c in ("data_source", "model_task", "model_scope", "model_layer", "meta_model", "meta_eval_type",
                        "model_name", "n_obs", "WAPE", "MAE", "RMSE", "Bias") if c in metric.columns]
    best = best_base(metric, g)
    cond = [comb[c].eqNullSafe(best[c]) for c in g]
    j = comb.select(*keep).alias("c").join(best.alias("b"), cond, "left")
    out = j.select(*[F.col(f"c.{c}").alias(c) for c in keep], "best_base_model", "best_base_wape")
    gap = F.col("WAPE") - F.col("best_base_wape")
    return out.withColumn("wape_vs_best_base", gap).withColumn("stacking_wins", F.coalesce(gap < 0, F.lit(False)))


def lead_week_summary(metric: DataFrame) -> DataFrame:
    """REP-8: by_lead_week rows, sorted by source, task, model and lead week."""
    keep = [c for c in ("data_source", "model_task", "model_scope", "model_layer", "model_name", "meta_model", "lead_week",
                        "n_obs", "WAPE", "MAE", "RMSE", "Pearson", "HitRate", "Bias") if c in metric.columns]
    lw = metric.where(F.col("metric_level") == "by_lead_week").select(*keep)
    return lw.orderBy(*[c for c in ("data_source", "model_task", "model_name", "lead_week") if c in keep])


#: Settings that are texts; one without a value is a null of its kind.
TEXT_SETTINGS = ("task", "run_mode", "sources", "feature_set", "feature_select", "covid_policy", "meta_model", "compare_meta_models")


def run_summary(metric: DataFrame, settings: dict) -> DataFrame:
    """AGG-15 (+ SRT-8): one row of run settings, row counts and the best leaderboard model."""
    overall = F.col("metric_level") == "overall"
    mm = model_method(metric)
    order = F.struct(F.col("WAPE").isNull().alias("_missing"), F.col("WAPE").alias("_w"), mm.alias("_m"))
    stats = metric.agg(
        F.count(F.lit(1)).alias("metric_rows"),
        F.count_if(overall).alias("leaderboard_rows"),
        F.min_by(F.when(overall, mm), F.when(overall, order)).alias("best_model_by_wape"),
        F.min(F.when(overall, F.col("WAPE"))).alias("best_wape"),
    )
    lits = [(F.lit(v) if v is not None else F.lit(None).cast("string" if k in TEXT_SETTINGS else "int")).alias(k) for k, v in settings.items()]
    return stats.select(*lits, "metric_rows", "leaderboard_rows", "best_model_by_wape", "best_wape")


def holdout_leaderboard(metric: DataFrame) -> DataFrame:
    """REP-10: overall holdout rows by source, task, WAPE."""
    keys = [c for c in ("data_source", "model_task") if c in metric.columns]
    return metric.where(F.col("metric_level") == "overall").orderBy(*keys, F.col("WAPE").asc_nulls_last())


def chart_series(actual: DataFrame, prediction: DataFrame, plot_weeks: int, key_cols, holdout_start_week: int) -> DataFrame:
    """REP-9 (+ FIL-16, JOI-16, SCA-13): recent actuals and holdout predictions per series, chart-ready.

    Keeps the last ``plot_weeks`` distinct weeks of the actuals, joins the
    predictions by (series, week), and marks the holdout start; series without
    actuals in the window are skipped.
    """
    weeks = actual.select("yearweek").distinct()
    cutoff = weeks.orderBy(F.col("yearweek").desc()).limit(int(plot_weeks)).agg(F.min("yearweek"))
    recent = actual.where(F.col("yearweek") >= cutoff.scalar()).select(*key_cols, "yearweek", F.col("count").alias("actual_count"))
    has = recent.select(*key_cols).distinct()
    pred = prediction.join(has, list(key_cols), "left_semi").select(*key_cols, "yearweek", "forecast_count")
    j = recent.join(pred, [*key_cols, "yearweek"], "full")
    name = F.translate(F.concat_ws("_", *[F.col(c).cast("string") for c in key_cols]), "/ ", "__")
    return j.select(*key_cols, "yearweek", "actual_count", "forecast_count", name.alias("series_name"),
                    (F.col("yearweek") >= F.lit(int(holdout_start_week))).alias("in_holdout"))


OUTPUT_ORDER = {
    # SRT-1 / SRT-4: sink ordering of the output frames
    "feature_table": ["data_source", "disease", "county", "yearweek", "is_future"],
    "predictions": ["data_source", "model_task", "disease", "county", "yearweek"],
    "base_predictions": ["data_source", "model_task", "base_model", "disease", "county", "yearweek"],
    "metrics": ["data_source", "model_task", "model_name", "metric_level", "disease", "county", "lead_week"],
    "features": ["data_source", "model_task", "feature_type", "feature"],
}


def sorted_for_output(df: DataFrame, kind: str) -> DataFrame:
    """Order a frame for writing (only at the sink; never inside the pipeline)."""
    return df.orderBy(*[c for c in OUTPUT_ORDER[kind] if c in df.columns])


def feature_table_summary(feature: DataFrame, max_places: int = 30) -> DataFrame:
    """AGG-17: diseases and places of each source, and the names of the first ``max_places`` places.

    Distinct (source, place) pairs come first, so a source's names are ranked from one row per place.
    """
    from pyspark.sql import Window

    counts = feature.groupBy("data_source").agg(
        F.count_distinct("disease").alias("n_diseases"), F.count_distinct("county").alias("county_count"))
    places = feature.select("data_source", "county").where(F.col("county").isNotNull()).distinct()
    ranked = places.withColumn("_r", F.row_number().over(Window.partitionBy("data_source").orderBy("county")))
    names = ranked.where(F.col("_r") <= max_places).groupBy("data_source").agg(
        F.array_join(F.array_sort(F.collect_list("county")), ",").alias("counties"))
    return counts.join(names, "data_source", "left").select(
        "data_source", "n_diseases", "county_count", F.coalesce("counties", F.lit("")).alias("counties"))

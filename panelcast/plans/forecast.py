"""Forecast and holdout runs for one modelling task (PAN-7, CV-8, REP-2..4, SET-2, SET-6, SET-9).

The driver only holds column lists, the fold arithmetic over distinct weeks
and a few scalars; every data step is a Spark job. The panels that several
stages re-read (training features, the prediction matrix) are checkpointed
into ``spark.checkpoint.dir`` so a lost executor does not replay the whole plan.
"""

from __future__ import annotations

import datetime as dt
import warnings
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast import config as C
from panelcast.operators import evaluate as EV
from panelcast.operators import features as FE
from panelcast.operators import oof as OO
from panelcast.operators import panel as PN
from panelcast.operators import splits as SP
from panelcast.operators import stacking as ST
from panelcast.operators.models import resolve_allowed_registry
from panelcast.operators.selection import select_features
from panelcast.session import reliable_checkpoint
from panelcast.sources.calendar import forecast_yearweeks, latest_closed_yearweek
from panelcast.sources.scans import week_range_filter

ID = [*C.KEY_COLS, "yearweek"]


@dataclass
class TaskInputs:
    """Normalised inputs of one source (see ``panelcast.sources``)."""

    target: DataFrame
    source_total: DataFrame | None
    weather: DataFrame | None
    calendar: DataFrame | None
    weekdate: DataFrame
    location_map: DataFrame | None = None


@dataclass
class RunOptions:
    run_mode: str = "smoke"
    forecast_period: int = field(default_factory=lambda: C.RunDefaults.from_env().forecast_period)
    train_start: int | None = field(default_factory=lambda: C.RunDefaults.from_env().train_start_yearweek)
    covid_policy: str = "include"
    covid_years: tuple = C.COVID_YEARS
    meta_model: str = "ridge"
    recent_weeks: int | None = None
    feature_set: str | None = None
    feature_select: str | None = None
    top_k: int | None = None
    models: tuple | None = None  # the pool to choose from instead of the run mode's
    compare: tuple = ()  # further combiners to score on the same base predictions (CV-7)
    topk: int | None = None  # models that a top-k average takes
    enable_grid_search: bool = False
    grid_cv_splits: int = 3
    ev_disease: str = C.EV_DISEASE
    offshore: tuple = C.OFFSHORE_COUNTIES
    source_kind: str | None = None


def _persist(df: DataFrame) -> DataFrame:
    return reliable_checkpoint(df)


def prepare(inputs: TaskInputs, data_source: str, model_task: str, opts: RunOptions, weeks: list[int]):
    """Feature table, task geography, COVID policy and exogenous columns."""
    cfg = C.resolve_config(opts.run_mode, opts.recent_weeks, opts.feature_set, opts.feature_select, opts.top_k)
    target = week_range_filter(inputs.target, opts.train_start, None)
    feature = PN.build_feature_table(target, inputs.source_total, inputs.weather, inputs.calendar, weeks)
    feature, removed = PN.prepare_task(feature, data_source, model_task, inputs.location_map, opts.ev_disease,
                                       opts.offshore, opts.source_kind)
    feature = PN.apply_covid_policy(feature, opts.covid_policy, opts.covid_years)
    return cfg, feature, removed, PN.model_exog_columns(feature)


def fit_models(train: DataFrame, cfg, specs, numeric, categorical, opts: RunOptions):
    """The folds of a run, and its global models fitted on each fold and on all training rows, together."""
    folds = SP.fold_table(train.sparkSession, SP.rolling_splits(SP.distinct_weeks(train), cfg.folds.n_splits, cfg.folds.min_train_weeks))
    feats = categorical + numeric
    rows = _persist(train.select(*ID, "count", *[c for c in feats if c not in ID]))
    return folds, OO.fit_globals(rows, folds, specs, numeric, categorical, grid_search=opts.enable_grid_search,
                                 grid_splits=opts.grid_cv_splits)


def _with_naive(long: DataFrame | None, naive, specs) -> DataFrame:
    """Long predictions of the global models and, if the pool has it, of the naive one."""
    parts = [] if long is None else [long]
    if any(s.scope == "naive" for s in specs):
        parts.append(naive().select(*ID, F.lit("seasonal_naive").alias("model_name"), "y_pred"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def oof_matrix(train: DataFrame, folds: DataFrame, fits: OO.GlobalFits, specs):
    """Base OOF prediction matrix (global models + seasonal naive), wide, one column per model."""
    long = _with_naive(fits.predictions(fits.valid, ID), lambda: OO.local_oof_seasonal_naive(train, folds, out_col="y_pred"), specs)
    names = [s.name for s in specs if s.scope == "global_panel"] + [s.name for s in specs if s.scope == "naive"]
    wide = long.groupBy(*ID).pivot("model_name", names).agg(F.first("y_pred"))
    matrix = train.select(*ID, F.col("count").alias("y_true")).join(wide, ID, "left")
    return _persist(matrix), names


def final_base(train: DataFrame, future: DataFrame, fits: OO.GlobalFits, specs, names) -> DataFrame:
    """MOD-10 + MOD-11: the models refitted on all training rows on the future rows (wide)."""
    long = _with_naive(fits.predictions({OO.FINAL: future}, ID), lambda: OO.final_seasonal_naive(train, future, out_col="y_pred"), specs)
    wide = long.groupBy(*ID).pivot("model_name", names).agg(F.first("y_pred"))
    return future.select(*ID, "lead_week").join(wide, ID, "left")


def impute_predictions(df: DataFrame, model_cols) -> DataFrame:
    """MOD-11: a missing base prediction takes its column's median over the batch, then 0."""
    from panelcast.functions.metrics import finite

    med = ST.gap_medians(df, model_cols)
    return df.select(*[F.coalesce(finite(c), F.lit(med[c]), F.lit(0.0)).alias(c) if c in model_cols else F.col(c)
                       for c in df.columns])


def usable_models(matrix: DataFrame, names) -> list[str]:
    """The models with predictions; fewer than two, or no row that all of them predict, is an error."""
    from panelcast.operators.combine import complete_cases, drop_empty_models

    used = drop_empty_models(matrix, names)
    if len(used) < 2:
        raise RuntimeError(f"a combiner takes two base models at least; {len(used)} made predictions")
    if complete_cases(matrix, used).isEmpty():
        raise RuntimeError("no row has a prediction of every base model")
    return used


def combiner_metric(matrix: DataFrame, used, meta_model: str, n_splits: int, context: dict, topk: int | None = None):
    """Metric rows of one combiner over the base predictions, and how it was evaluated."""
    from panelcast.operators.combine import complete_cases

    stacked, eval_type = ST.meta_oof(matrix, used, meta_model, ID, n_splits, topk=topk)
    sv = complete_cases(matrix, used).select(*ID, "y_true")
    long = EV.with_context(sv.join(stacked, ID, "left"), {
        **context, "model_layer": C.combiner_layer(meta_model), "model_name": C.combiner_model_name(meta_model)})
    metric = EV.metric_levels(long, [*context.keys(), "model_layer", "model_name"])
    return metric.withColumn("meta_model", F.lit(meta_model)).withColumn("meta_eval_type", F.lit(eval_type)), eval_type


def evaluate(matrix: DataFrame, names, meta_model: str, n_splits: int, context: dict, topk: int | None = None):
    """Base and combiner metric rows (AGG-5) from the OOF matrix; returns (metric, eval_type, meta, used models)."""
    used = usable_models(matrix, names)
    base_long = EV.to_long(matrix, [*ID, "y_true"], used)
    base_long = EV.with_context(base_long, {**context, "model_layer": "base"})
    base_metric = EV.metric_levels(base_long, [*context.keys(), "model_layer", "model_name"])
    comb_metric, eval_type = combiner_metric(matrix, used, meta_model, n_splits, context, topk)
    metric = base_metric.withColumn("meta_model", F.lit(meta_model)).withColumn("meta_eval_type", F.lit(eval_type)) \
        .unionByName(comb_metric)
    return metric, eval_type, ST.fit_combiner(matrix, used, meta_model, topk=topk), used


def run_settings(opts: RunOptions, cfg) -> dict:
    """COL-18: the settings of a run, as they stand on its output rows."""
    return {"run_mode": opts.run_mode, "feature_set": cfg.features.name, "feature_select": cfg.features.select,
            "top_k": cfg.features.top_k, "covid_policy": opts.covid_policy, "enable_grid_search": opts.enable_grid_search}


def with_settings(df: DataFrame, settings: dict, **more) -> DataFrame:
    """Setting columns on every row (a null ``top_k`` stays an integer column)."""
    kinds = {"top_k": "int", "enable_grid_search": "boolean", "holdout_weeks": "int", "holdout_start": "int", "holdout_end": "int"}
    return df.withColumns({k: F.lit(v).cast(kinds.get(k, "string")) for k, v in {**settings, **more}.items()})


def feature_report(numeric_report: DataFrame, categorical, data_source: str, model_task: str) -> DataFrame:
    """REP-4 + SET-9: numeric profile/selection rows plus one row per categorical feature."""
    num = numeric_report.select("*", F.lit("numeric").alias("feature_type"))
    spark = numeric_report.sparkSession
    cat = spark.createDataFrame([(c,) for c in categorical] or [("",)], "feature string")
    if not categorical:
        cat = cat.limit(0)
    cat = cat.select("feature", F.lit("categorical").alias("feature_type"), F.lit("string").alias("dtype"),
                     F.lit(True).alias("selected"), F.lit("categorical").alias("selection_stage"))
    out = num.unionByName(cat, allowMissingColumns=True)
    return out.select("*", F.lit(data_source).alias("data_source"), F.lit(model_task).alias("model_task"))


def compare_meta_models(matrix: DataFrame, names, methods, n_splits: int, context: dict, topk: int | None = None) -> DataFrame:
    """CV-7: metric rows of several combiners over the same base predictions; no base metric or final fit is repeated."""
    used = usable_models(matrix, names)
    out = None
    for m in methods:
        comb, _ = combiner_metric(matrix, used, m, n_splits, context, topk)
        out = comb if out is None else out.unionByName(comb)
    return out


def run_forecast(inputs: TaskInputs, data_source: str, model_task: str, base_date: dt.date,
                 opts: RunOptions | None = None) -> dict[str, DataFrame]:
    """PAN-7: one task end to end; returns forecast, base_prediction, metric and feature_report frames."""
    opts = opts or RunOptions()
    weeks = forecast_yearweeks(inputs.weekdate, opts.forecast_period, base_date)
    cut = latest_closed_yearweek(inputs.weekdate, base_date)
    cfg, feature, removed, exog = prepare(inputs, data_source, model_task, opts, weeks)
    base_train = _persist(PN.apply_recent_weeks(PN.training_rows(feature, cut), cfg.recent_weeks))
    if base_train.isEmpty():
        raise RuntimeError(f"source {data_source} has no rows to train on up to week {cut}")
    kept, rejected = PN.complete_horizon(PN.future_rows(feature, weeks), opts.forecast_period)
    train = FE.lag_rolling_features(base_train, cfg.features.name).where(F.col("lag_1").isNotNull() & F.col("count").isNotNull())
    train = _persist(train)
    future = _persist(FE.future_features(base_train, kept, cfg.features.name, opts.forecast_period))
    _, numeric_all, categorical = FE.feature_columns(train, exog)
    sel = select_features(train, numeric_all, cfg.features.select, cfg.features.top_k)
    numeric = sel.numeric_cols
    if not numeric:
        raise RuntimeError("feature selection left no numeric feature")
    specs = resolve_allowed_registry(model_task, opts.models or cfg.models)
    meta_info = C.task_metadata(model_task)
    context = {"data_source": data_source, "model_task": model_task, "model_scope": meta_info["model_scope"],
               "prediction_type": "oof"}
    folds, fits = fit_models(train, cfg, specs, numeric, categorical, opts)
    matrix, names = oof_matrix(train, folds, fits, specs)
    settings = run_settings(opts, cfg)
    metric, eval_type, meta, used = evaluate(matrix, names, opts.meta_model, cfg.folds.n_splits, context, opts.topk)
    metric = _persist(with_settings(metric, settings))
    compared = compare_meta_models(matrix, names, opts.compare, cfg.folds.n_splits, context, opts.topk) if opts.compare else None
    fb = final_base(train, future, fits, specs, names).select(*ID, "lead_week", *used)
    fb = _persist(impute_predictions(fb, used))
    stacked_future = ST.predict_combiner(meta, fb, ID).withColumnRenamed("y_pred", "_stack")
    choice = EV.select_final_model(metric, opts.meta_model, eval_type).first()
    final_name, final_layer = choice["final_model_name"], choice["final_model_layer"]
    j = fb.join(stacked_future, ID, "left")
    pred = F.col(final_name) if final_layer == "base" else F.col("_stack")
    flags = [F.lit(v).alias(k) for k, v in meta_info.items() if k != "model_scope"]
    forecast = j.select(
        *ID, "lead_week", pred.alias("forecast_count"),
        F.greatest(F.rint(F.coalesce(pred, F.lit(0.0))), F.lit(0.0)).cast("long").alias("forecast_count_rounded"),
        F.lit(final_name).alias("model_name"), F.lit(final_layer).alias("model_layer"),
        F.lit(model_task).alias("model_task"), F.lit(meta_info["model_scope"]).alias("model_scope"), *flags,
        F.lit(bool(removed)).alias("weather_removed"),
    )
    forecast = with_settings(forecast, settings)
    base_long = EV.to_long(fb, [*ID, "lead_week"], used, name_col="base_model", value_col="_p", drop_missing=False)
    base_pred = base_long.select(
        *ID, "lead_week", "base_model",
        F.greatest(F.rint(F.coalesce("_p", F.lit(0.0))), F.lit(0.0)).cast("long").alias("forecast_count"),
        F.lit(model_task).alias("model_task"), F.lit(meta_info["model_scope"]).alias("model_scope"), *flags,
        F.lit(bool(removed)).alias("weather_removed"),
    )
    base_pred = with_settings(base_pred, {k: settings[k] for k in ("run_mode", "feature_set")})
    report = feature_report(sel.report, categorical, data_source, model_task)
    out = {"forecast": forecast, "base_prediction": base_pred, "metric": metric, "feature_report": report,
           "rejected_series": rejected}
    weights = ST.combiner_weights(meta)
    if weights is not None:
        out["combiner_weights"] = weights
    if compared is not None:
        out["combiner_comparison"] = with_settings(compared, settings)
    return out


def holdout_weeks(hist: DataFrame, end_week: int, n: int) -> list[int]:
    """FIL-8: the last n distinct weeks up to end_week; not more weeks than that is an error."""
    weeks = SP.distinct_weeks(hist.where(F.col("yearweek") <= int(end_week)))
    if len(weeks) <= n:
        raise RuntimeError(f"{n} weeks cannot be held out of {len(weeks)}")
    if len(weeks) < n + C.SEASON_LENGTH:
        warnings.warn(f"{len(weeks)} weeks leave less than a season before the {n} that are held out", stacklevel=2)
    return weeks[-n:]


@dataclass
class HoldoutSplit:
    """A panel cut for a back-test: the weeks held out, and the rows on both sides."""

    weeks: list[int]
    base_train: DataFrame
    raw: DataFrame  # the held-out rows with their counts
    kept: DataFrame  # those of series with a row in every held-out week, without their counts
    rejected: DataFrame  # the other series and their number of rows

    def lead(self, week="yearweek"):
        """Place of a held-out week, from 1."""
        return F.create_map(*[x for i, w in enumerate(self.weeks) for x in (F.lit(w), F.lit(i + 1))])[F.col(week)]

    def actual(self, name: str) -> DataFrame:
        return self.raw.select(*ID, F.col("count").alias(name))


def split_holdout(hist: DataFrame, end_week: int, n: int, recent_weeks: int | None = None) -> HoldoutSplit:
    """FIL-8..10: the last ``n`` weeks up to ``end_week`` are held out, with their counts and rates hidden."""
    weeks = holdout_weeks(hist, end_week, n)
    raw = hist.where(F.col("yearweek").isin(*weeks))
    hidden = raw.withColumns({c: F.lit(None).cast("double") for c in ("count", "disease_rate")})
    kept, rejected = PN.complete_horizon(hidden, n)
    base_train = PN.apply_recent_weeks(hist.where(~F.col("yearweek").isin(*weeks)), recent_weeks)
    return HoldoutSplit(weeks, base_train, raw, kept, rejected)


def run_holdout(inputs: TaskInputs, data_source: str, model_task: str, base_date: dt.date, end_week: int,
                n_holdout: int = 8, opts: RunOptions | None = None) -> dict[str, DataFrame]:
    """CV-8: back-test the last ``n_holdout`` weeks; the combiner's predictions are scored with lead-week metrics."""
    opts = opts or RunOptions()
    weeks = forecast_yearweeks(inputs.weekdate, opts.forecast_period, base_date)
    cfg, feature, removed, exog = prepare(inputs, data_source, model_task, opts, weeks)
    hist = _persist(feature.where((~F.col("is_future")) & F.col("count").isNotNull() & (F.col("yearweek") <= int(end_week))))
    split = split_holdout(hist, end_week, n_holdout, cfg.recent_weeks)
    hw, kept, rejected, actual = split.weeks, split.kept, split.rejected, split.actual("actual_count")
    base_train = _persist(split.base_train)
    train = _persist(FE.lag_rolling_features(base_train, cfg.features.name)
                     .where(F.col("lag_1").isNotNull() & F.col("count").isNotNull()))
    hf = FE.future_features(base_train, kept, cfg.features.name, n_holdout)
    hf = _persist(hf.withColumnRenamed("lead_week", "_step").withColumn("lead_week", split.lead()))
    _, numeric_all, categorical = FE.feature_columns(train, exog)
    sel = select_features(train, numeric_all, cfg.features.select, cfg.features.top_k)
    numeric = sel.numeric_cols
    if not numeric:
        raise RuntimeError("feature selection left no numeric feature")
    specs = resolve_allowed_registry(model_task, opts.models or cfg.models)
    meta_info = C.task_metadata(model_task)
    folds, fits = fit_models(train, cfg, specs, numeric, categorical, opts)
    matrix, names = oof_matrix(train, folds, fits, specs)
    used = usable_models(matrix, names)
    meta = ST.fit_combiner(matrix, used, opts.meta_model, topk=opts.topk)
    fb = final_base(train, hf.withColumn("lead_week", F.col("_step")), fits, specs, names)
    fb = fb.drop("lead_week").join(hf.select(*ID, "lead_week"), ID).select(*ID, "lead_week", *used)
    fb = _persist(impute_predictions(fb, used))
    pred = ST.predict_combiner(meta, fb, ID)
    out = fb.select(*ID, "lead_week").join(pred, ID).join(actual, ID, "left")
    predictions = out.select(
        *ID, "lead_week", "actual_count", F.col("y_pred").alias("forecast_count"),
        F.greatest(F.rint(F.col("y_pred")), F.lit(0.0)).cast("long").alias("forecast_count_rounded"),
        F.lit(C.combiner_model_name(opts.meta_model)).alias("model_name"),
        F.lit(C.combiner_layer(opts.meta_model)).alias("model_layer"),
        F.lit(model_task).alias("model_task"), F.lit(meta_info["model_scope"]).alias("model_scope"),
    )
    context = {"data_source": data_source, "model_task": model_task, "model_scope": meta_info["model_scope"],
               "prediction_type": "holdout"}
    comb = EV.with_context(predictions.select(*ID, "lead_week", F.col("actual_count").alias("y_true"),
                                              F.col("forecast_count").alias("y_pred")),
                           {**context, "model_layer": C.combiner_layer(opts.meta_model),
                            "model_name": C.combiner_model_name(opts.meta_model)})
    base_long = EV.to_long(fb.join(actual, ID, "left"), [*ID, "lead_week", "actual_count"], used)
    base_long = EV.with_context(base_long.withColumnRenamed("actual_count", "y_true"), {**context, "model_layer": "base"})
    group = [*context.keys(), "model_layer", "model_name"]
    metric = EV.metric_levels(comb, group, by_lead_week=True).unionByName(
        EV.metric_levels(base_long, group, by_lead_week=True)).withColumn("meta_model", F.lit(opts.meta_model))
    base_pred = EV.to_long(fb.join(actual, ID, "left"), [*ID, "lead_week", "actual_count"], used,
                           name_col="base_model", value_col="forecast_count")
    base_pred = base_pred.withColumn("forecast_count_rounded", F.greatest(F.rint("forecast_count"), F.lit(0.0)).cast("long"))
    settings = run_settings(opts, cfg)
    metric = with_settings(metric, settings, meta_eval_type="holdout_backtest", holdout_weeks=n_holdout,
                           holdout_start=hw[0], holdout_end=hw[-1])
    return {"predictions": with_settings(predictions, settings), "base_predictions": with_settings(base_pred, settings),
            "metric": metric, "used_features": sel.report, "holdout_weeks": hw, "actual_history": hist,
            "rejected_series": rejected}


def run_all(inputs_by_source: dict, base_date: dt.date, opts: RunOptions | None = None) -> dict[str, DataFrame]:
    """PAN-6 + SET-2: every task of every source, outputs concatenated by name (missing columns become NULL)."""
    out: dict[str, DataFrame] = {}
    for task in C.expand_model_tasks(list(inputs_by_source)):
        res = run_forecast(inputs_by_source[task["data_source"]], task["data_source"], task["model_task"], base_date, opts)
        for k, df in res.items():
            out[k] = df if k not in out else out[k].unionByName(df, allowMissingColumns=True)
    return out


def run_holdout_all(inputs_by_source: dict, base_date: dt.date, end_week: int, n_holdout: int = 8,
                    opts: RunOptions | None = None) -> dict[str, DataFrame]:
    """CV-8 over every task of every source; outputs concatenated by name (SET-2)."""
    out: dict[str, DataFrame] = {}
    for task in C.expand_model_tasks(list(inputs_by_source)):
        res = run_holdout(inputs_by_source[task["data_source"]], task["data_source"], task["model_task"], base_date,
                          end_week, n_holdout, opts)
        for k, df in res.items():
            if not isinstance(df, DataFrame):
                continue
            out[k] = df if k not in out else out[k].unionByName(df, allowMissingColumns=True)
    return out


def summary_settings(task: str, sources, opts: RunOptions, end_week: int | None = None, n_holdout: int | None = None,
                     plot_weeks: int | None = None) -> dict:
    """AGG-15: what a run summary says about a run (``task``: forecast or holdout), from its options as they took effect."""
    cfg = C.resolve_config(opts.run_mode, opts.recent_weeks, opts.feature_set, opts.feature_select, opts.top_k)
    holdout = task == "holdout"
    return {
        "task": task, "run_mode": opts.run_mode, "sources": ",".join(sources),
        "forecast_period": None if holdout else opts.forecast_period,
        "end_week": end_week if holdout else None, "holdout_weeks": n_holdout if holdout else None, "plot_weeks": plot_weeks if holdout else None,
        "start_week": opts.train_start, "recent_weeks": cfg.recent_weeks,
        "feature_set": cfg.features.name, "feature_select": cfg.features.select, "top_k": cfg.features.top_k,
        "covid_policy": opts.covid_policy, "enable_grid_search": opts.enable_grid_search, "grid_cv_splits": opts.grid_cv_splits,
        "meta_model": opts.meta_model, "compare_meta_models": ",".join(opts.compare) or None,
    }


def publish_reports(outputs: dict[str, DataFrame], out_dir: str, settings: dict, fmt: str = "parquet",
                    top_n: int = 200) -> dict[str, str]:
    """SNK-5 / SNK-6: derive the report frames from a run's outputs and write them (sorted at the sink).

    ``settings`` go into the run summary (see ``summary_settings``).
    """
    from panelcast.operators import reports as RP
    from panelcast.sources.sinks import write_outputs

    metric = outputs["metric"]
    frames = {
        "metric": RP.sorted_for_output(metric, "metrics"),
        "leaderboard": RP.leaderboard(metric),
        "breakdown": RP.breakdown(metric, top_n),
        "meta_model_comparison": RP.meta_model_comparison(metric),
        "lead_week_summary": RP.lead_week_summary(metric),
        "run_summary": RP.run_summary(metric, settings),
    }
    for name, kind in (("forecast", "predictions"), ("predictions", "predictions"),
                       ("base_prediction", "base_predictions"), ("base_predictions", "base_predictions"),
                       ("feature_report", "features"), ("used_features", "features")):
        if name in outputs and isinstance(outputs[name], DataFrame):
            frames[name] = RP.sorted_for_output(outputs[name], kind)
    return write_outputs(frames, out_dir, fmt)

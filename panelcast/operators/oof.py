"""Out-of-fold predictions (CV-4, CV-5, CV-6, CV-7, MOD-10).

Folds are joined to the panel on yearweek; the seasonal-naive model runs for
every (series, fold) at once, partitioned by series, with no Python loop.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast import config as C
from panelcast.operators.features import seasonal_naive
from panelcast.operators.splits import assign_folds


def local_oof_seasonal_naive(train: DataFrame, folds: DataFrame, key_cols=C.KEY_COLS,
                             out_col: str = "seasonal_naive") -> DataFrame:
    """CV-5: per series and fold, seasonal naive fitted on the fold's training rows, predicting its validation rows.

    Returns key_cols + yearweek + ``out_col`` for validation rows of series that
    have rows on both sides of the fold.
    """
    tr = assign_folds(train.select(*key_cols, "yearweek", "count"), folds, "train")
    va = assign_folds(train.select(*key_cols, "yearweek"), folds, "valid")
    va = va.withColumn("h", F.row_number().over(Window.partitionBy(*key_cols, "fold").orderBy("yearweek")))
    pred = seasonal_naive(tr, va, [*key_cols, "fold"], "count", out_col=out_col)
    return pred.select(*key_cols, "yearweek", out_col)


def final_seasonal_naive(train: DataFrame, future: DataFrame, key_cols=C.KEY_COLS,
                         out_col: str = "seasonal_naive") -> DataFrame:
    """MOD-10 for the naive model: fit on all training rows of a series, predict its future rows (``lead_week`` = step)."""
    targets = future.select(*key_cols, "yearweek", F.col("lead_week").alias("h"))
    pred = seasonal_naive(train.select(*key_cols, "yearweek", "count"), targets, key_cols, "count", out_col=out_col)
    return pred.select(*key_cols, "yearweek", out_col)


@dataclass
class GlobalFits:
    """Fitted global models: per fold its validation rows, and per (model name, fold) the model; the fold of the refit on
    all training rows is ``FINAL``."""

    valid: dict
    models: dict

    def predictions(self, frames: dict, id_cols) -> DataFrame | None:
        """Long predictions (id_cols, ``model_name``, ``y_pred``) of each fold's models on its frame, all models of a fold in one pass."""
        out = None
        for fold, df in frames.items():
            mine = {name: m for (name, f), m in self.models.items() if f == fold}
            if not mine:
                continue
            wide = df
            for name, m in mine.items():
                wide = m.predict(wide, f"_p_{name}")
            made = F.explode(F.array(*(F.struct(F.lit(n).alias("model_name"), F.col(f"_p_{n}").cast("double").alias("y_pred")) for n in mine)))
            long = wide.select(*id_cols, made.alias("_p")).select(*id_cols, "_p.model_name", "_p.y_pred")
            out = long if out is None else out.unionByName(long)
        return out


#: The group of weeks that is all training rows.
FINAL = -1


def fit_globals(train: DataFrame, folds: DataFrame | None, specs, numeric, categorical, y: str = "count", grid_search: bool = False,
                grid_splits: int = 3, final: bool = True) -> GlobalFits:
    """CV-4 + MOD-10: every global model on every fold's training rows and (``final``) on all of them.

    Preprocessing of all folds takes one pass for moments, medians and levels each;
    the boosted models of all folds and the refit grow in lock step; the linear ones
    come from one aggregation. ``train`` should be materialised by the caller.
    """
    from panelcast.operators import linear as LN
    from panelcast.operators import models as MD
    from panelcast.operators.splits import distinct_weeks

    todo = [s for s in specs if s.scope == "global_panel" and s.enabled]
    groups: dict = {}
    weeks: dict = {}
    for r in folds.collect() if folds is not None and todo else []:
        (groups if r["role"] == "train" else weeks).setdefault(r["fold"], []).append(r["yearweek"])
    valid = {i: train.where(F.col("yearweek").isin(*w)) for i, w in weeks.items()}
    if final and todo:
        groups[FINAL] = distinct_weeks(train)
    if not groups:
        return GlobalFits(valid, {})
    pres, fixed = MD.group_preprocess(train, groups, numeric, categorical, y)
    models = {(s.name, i): MD.ConstantModel(v) for s in todo for i, v in fixed.items()}
    rows = {i: train if i == FINAL else train.where(F.col("yearweek").isin(*groups[i])) for i in pres}
    chosen = {(name, i): params for i in rows for name, params in MD.grid_search(rows[i], todo, numeric, categorical, y, grid_splits).items()} \
        if grid_search else {}
    boosted = [(s, i) for s in todo if s.preset for i in pres]
    jobs = [(i, rows[i], pres[i], MD.boosting_params(s.preset, **chosen.get((s.name, i), {}))) for s, i in boosted]
    models |= {(s.name, i): m for (s, i), m in zip(boosted, MD.fit_boosted(jobs, numeric, categorical, y))}
    linear = [s for s in todo if s.linear is not None]
    eqs = MD.group_equations(train, groups, pres, y) if linear and pres else {}
    for s in linear:
        for i, eq in eqs.items():
            models[s.name, i] = LN.LinearModel.of(pres[i], eq, eq.solve(**{**s.linear, **chosen.get((s.name, i), {})}))
    for s in todo:
        for i in rows if not s.preset and s.linear is None else ():
            models[s.name, i] = s.fit(rows[i], numeric, categorical, y, pre=pres[i])
    return GlobalFits(valid, models)


def global_oof(train: DataFrame, folds: DataFrame, specs, numeric, categorical, id_cols, y: str = "count",
               grid_search: bool = False, grid_splits: int = 3) -> DataFrame | None:
    """CV-4: every fold's models on its validation rows (long: id_cols + model_name + y_pred)."""
    fits = fit_globals(train, folds, specs, numeric, categorical, y, grid_search, grid_splits, final=False)
    return fits.predictions(fits.valid, id_cols)


def final_global_predictions(train: DataFrame, future: DataFrame, specs, numeric, categorical, id_cols,
                             y: str = "count") -> DataFrame | None:
    """MOD-10 for global models: refit on all training rows, predict the future rows (long output)."""
    return fit_globals(train, None, specs, numeric, categorical, y).predictions({FINAL: future}, id_cols)

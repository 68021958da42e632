"""Base models on Spark ML (MOD-1..5, MOD-7..9, MOD-11, CV-3).

Each estimator is fitted on a training DataFrame and returns a fitted object
whose ``predict(df, out)`` adds a prediction column. Preprocessing (median
imputation, standardisation with the population std, one-hot encoding with
unknown levels mapped to zeros) is fitted inside every fold.
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass, field
from typing import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast import config as C
from panelcast.functions.medians import grouped_medians
from panelcast.functions.metrics import finite
from panelcast.operators import boosting as BO
from panelcast.operators import linear as LN


# ---------------------------------------------------------------------------
# MOD-1: preprocessing
# ---------------------------------------------------------------------------
@dataclass
class Preprocessor:
    """What a model's columns need: medians for gaps, means and population deviations, modes and levels."""

    numeric: list
    categorical: list
    medians: dict
    means: dict
    scales: dict
    modes: dict = field(default_factory=dict)
    levels: dict = field(default_factory=dict)

    def filled_numbers(self) -> list:
        """Numeric columns with their medians in the gaps."""
        return [F.coalesce(finite(F.col(c).cast("double")), F.lit(float(self.medians.get(c) or 0.0))) for c in self.numeric]

    def filled(self) -> tuple:
        """Two array columns: numbers, and categories with their modes in the gaps."""
        names = [F.coalesce(F.col(c).cast("string"), F.lit(self.modes[c])) for c in self.categorical]
        return F.array(*self.filled_numbers()).cast("array<double>"), F.array(*names).cast("array<string>")

    def transform(self, df: DataFrame, out: str = "_features") -> DataFrame:
        """``df`` with the vector of scaled numbers and level indicators (an unknown level has none)."""
        from pyspark.ml.functions import array_to_vector

        parts = [F.array(*[(x - F.lit(self.means[c])) / F.lit(self.scales[c]) for c, x in zip(self.numeric, self.filled_numbers())]).cast("array<double>")]
        for c in self.categorical:
            name = F.coalesce(F.col(c).cast("string"), F.lit(self.modes[c]))
            known = F.array(*[F.lit(v) for v in self.levels[c]]).cast("array<string>")
            parts.append(F.transform(known, lambda v, name=name: (v == name).cast("double")))
        return df.select("*", array_to_vector(F.concat(*parts)).alias(out))


def fit_preprocess_groups(rows: DataFrame, numeric_cols, categorical_cols, group: str) -> dict:
    """MOD-1 for several groups of rows (folds) in one pass each for moments, medians and levels: {group: Preprocessor}."""
    numeric, categorical = list(numeric_cols), list(categorical_cols)
    xs = [finite(F.col(c).cast("double")) for c in numeric]
    # moments of the present values; those of the filled column follow from them (gaps sit at the median)
    moments = rows.groupBy(F.col(group).alias("_g")).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count(x).alias(f"k{i}") for i, x in enumerate(xs)],
        *[F.avg(x).alias(f"m{i}") for i, x in enumerate(xs)],
        *[F.var_pop(x).alias(f"v{i}") for i, x in enumerate(xs)],
    ).collect()
    found = grouped_medians(rows.select(group, *numeric), numeric, group) if numeric else {}
    seen: dict = {}
    if categorical:
        names = rows.select(F.col(group).alias("_g"), *[F.col(c).cast("string").alias(c) for c in categorical])
        for r in names.unpivot(["_g"], categorical, "column", "level").groupBy("_g", "column", "level").count().collect():
            seen.setdefault((r["_g"], r["column"]), {})[r["level"]] = r["count"]
    out = {}
    for row in moments:
        g, n = row["_g"], row["_n"] or 1
        medians, means, scales, modes, levels = {}, {}, {}, {}, {}
        for i, c in enumerate(numeric):
            med = found.get(g, {}).get(c)
            med = 0.0 if med is None else med
            k, m, v = row[f"k{i}"], row[f"m{i}"] or 0.0, row[f"v{i}"] or 0.0
            mean = (k * m + (n - k) * med) / n
            # total variance = within present values + between present mean / median groups
            var = (k * (v + (m - mean) ** 2) + (n - k) * (med - mean) ** 2) / n
            medians[c], means[c] = med, mean
            scales[c] = math.sqrt(var) if var > 1e-24 else 1.0
        for c in categorical:
            # most frequent first, ties by value; the first fills missing categories
            count = seen.get((g, c), {})
            levels[c] = sorted((v for v in count if v is not None), key=lambda v: (-count[v], v))
            modes[c] = levels[c][0] if levels[c] else ""
        out[g] = Preprocessor(numeric, categorical, medians, means, scales, modes, levels)
    return out


def fit_preprocess(train: DataFrame, numeric_cols, categorical_cols) -> Preprocessor:
    """MOD-1: medians, moments, modes and levels of the training rows."""
    numeric, categorical = list(numeric_cols), list(categorical_cols)
    got = fit_preprocess_groups(train.select(F.lit(0).alias("_one"), *dict.fromkeys([*numeric, *categorical])), numeric, categorical, "_one")
    if got:
        return got[0]
    zero, one = dict.fromkeys(numeric, 0.0), dict.fromkeys(numeric, 1.0)
    return Preprocessor(numeric, categorical, zero, dict(zero), one, dict.fromkeys(categorical, ""), {c: [] for c in categorical})


# ---------------------------------------------------------------------------
# fitted model wrappers
# ---------------------------------------------------------------------------
@dataclass
class SparkModel:
    pre: Preprocessor
    model: object

    def predict(self, df: DataFrame, out: str = "y_pred") -> DataFrame:
        x = self.pre.transform(df)
        self.model.setFeaturesCol("_features").setPredictionCol("_p")
        p = self.model.transform(x)
        keep = [c for c in df.columns]
        return p.select(*keep, F.col("_p").alias(out))


@dataclass
class ConstantModel:
    """MOD-7: constant prediction (the single training value, 0.0 when empty)."""

    value: float

    def predict(self, df: DataFrame, out: str = "y_pred") -> DataFrame:
        return df.withColumn(out, F.lit(float(self.value)))


@dataclass
class BoostedModel:
    """A fitted ensemble of histogram trees; ``booster`` holds the trees."""

    pre: Preprocessor
    booster: BO.Booster

    def column(self):
        """The prediction as a column (Arrow batches)."""
        from pyspark.sql.functions import pandas_udf

        booster, n_num, n_cat = self.booster, len(self.pre.numeric), len(self.pre.categorical)

        @pandas_udf("double")
        def run(numbers: pd.Series, names: pd.Series) -> pd.Series:
            x = np.stack(numbers.to_numpy()) if n_num else np.zeros((len(numbers), 0))
            c = np.stack(names.to_numpy()).T if n_cat else []
            return pd.Series(booster.predict(x, list(c)))

        numbers, names = self.pre.filled()
        return run(numbers, names)

    def predict(self, df: DataFrame, out: str = "y_pred") -> DataFrame:
        return df.select("*", self.column().alias(out))


def constant_targets(train: DataFrame, y: str, group_cols=()) -> DataFrame:
    """AGG-14: per group whether the target has at most one distinct value, and that value (0 without any).

    Smallest equal to largest says so in one pre-aggregated pass.
    """
    v = finite(F.col(y).cast("double"))
    same = F.coalesce(F.min(v) == F.max(v), F.lit(True))
    return train.groupBy(*group_cols).agg(
        same.alias("is_constant"), F.when(same, F.coalesce(F.max(v), F.lit(0.0))).alias("value"))


def constant_target(train: DataFrame, y: str) -> float | None:
    """AGG-14: the constant value when the target has at most one distinct non-null value, else None."""
    r = constant_targets(train, y).first()
    return r["value"] if r["is_constant"] else None


# ---------------------------------------------------------------------------
# MOD-2..5: estimators
# ---------------------------------------------------------------------------
def normal_equations(rows: DataFrame, pres: dict, members: dict, y: str, segment: str) -> dict:
    """Normal equations of several groups of rows from one aggregation.

    ``segment`` is a column of ``rows``; ``members`` tells which segments each group takes in.
    """
    first = next(iter(pres.values()))
    levels = {c: sorted({v for p in pres.values() for v in p.levels[c]}) for c in first.categorical}
    centre = rows.agg(F.avg(F.col(y).cast("double"))).first()[0] or 0.0
    cols = LN.Columns(first.numeric, first.means, levels, centre)
    sums = LN.sums_of_products(rows, cols, y, segment)
    out = {}
    for g, pre in pres.items():
        mine = [sums[s] for s in members[g] if s in sums]
        if mine:
            out[g] = LN.equations(sum(mine), cols, pre)
    return out


# ---------------------------------------------------------------------------
# several groups of weeks (folds, the refit on all rows) at once
# ---------------------------------------------------------------------------
def _week_table(train: DataFrame, rows: list[tuple[int, int]], name: str) -> DataFrame:
    """Training rows with the labels of their week (weeks x labels rows are broadcast, both bounded by the calendar)."""
    return train.join(F.broadcast(train.sparkSession.createDataFrame(rows, f"yearweek int, {name} int")), "yearweek")


def group_preprocess(train: DataFrame, groups: dict, numeric, categorical, y: str = "count") -> tuple[dict, dict]:
    """Per group of weeks ({group number: weeks}): its preprocessing, and the value of a constant target (these two cover all groups)."""
    rows = _week_table(train, [(int(w), g) for g, weeks in groups.items() for w in weeks], "_group")
    fixed = {r["_group"]: r["value"] for r in constant_targets(rows, y, ["_group"]).where("is_constant").collect()}
    fixed |= {g: 0.0 for g in groups if not groups[g]}
    varying = [g for g in groups if g not in fixed]
    if not varying:
        return {}, fixed
    wanted = rows.where(F.col(y).isNotNull() & F.col("_group").isin(*varying))
    return fit_preprocess_groups(wanted, numeric, categorical, "_group"), fixed


def group_equations(train: DataFrame, groups: dict, pres: dict, y: str = "count") -> dict:
    """Normal equations of every group of weeks from one pass over the rows.

    Weeks that the same groups take in are one segment: a group's sums are the sum of its segments'.
    """
    taken: dict = {}
    for g in pres:
        for w in groups[g]:
            taken.setdefault(int(w), []).append(g)
    kinds = {pattern: i for i, pattern in enumerate(sorted({tuple(v) for v in taken.values()}))}
    rows = _week_table(train, [(w, kinds[tuple(v)]) for w, v in taken.items()], "_segment")
    return normal_equations(rows, pres, {g: [i for pattern, i in kinds.items() if g in pattern] for g in pres}, y, "_segment")


def fit_linear(train: DataFrame, numeric, categorical, y: str = "count", alpha: float = 1.0, l1_ratio: float = 0.0,
               loss: str = "squaredError", epsilon: float = 1.35, pre: Preprocessor | None = None):
    """MOD-2 / MOD-3 (and the stacking estimators): penalised least squares on the preprocessed features.

    Ridge minimises ``|y - Xw|^2 + alpha |w|^2``, elastic net (``l1_ratio`` above 0)
    ``|y - Xw|^2 / 2n + alpha l1 |w|_1 + alpha (1 - l1) / 2 |w|^2``, both from one
    aggregation of the sums of products (see ``operators.linear``) at every size;
    Huber regression is Spark ML's.
    """
    data = train.where(F.col(y).isNotNull()).withColumn("_y", F.col(y).cast("double"))
    pre = pre or fit_preprocess(data, numeric, categorical)
    if loss != "huber":
        eq = normal_equations(data.withColumn("_segment", F.lit(0)), {0: pre}, {0: [0]}, "_y", "_segment")[0]
        return LN.LinearModel.of(pre, eq, eq.solve(alpha, l1_ratio))
    from pyspark.ml.regression import LinearRegression

    x = pre.transform(data).select("_features", "_y").persist()
    lr = LinearRegression(loss="huber", epsilon=epsilon, regParam=alpha / max(x.count(), 1), elasticNetParam=0.0,
                          standardization=False, labelCol="_y", featuresCol="_features")
    model = lr.fit(x)
    x.unpersist()
    return SparkModel(pre, model)


#: Settings of the boosted models: trees, learning rate, how trees grow, shares of rows and columns per tree, and each
#: kind's usual l2 penalty and leaf bounds.
GBT_PRESETS = {
    "xgboost": BO.Params(350, 0.04, "depth", depth=4, l2=1.0, min_hessian=1.0, rows=0.85, columns=0.85),
    "lightgbm": BO.Params(450, 0.04, "leaf", leaves=31, l2=0.0, min_rows=20, min_hessian=1e-3, rows=0.85, columns=0.85),
    "catboost": BO.Params(350, 0.04, "symmetric", depth=5, l2=3.0),
}
POISSON_PRESETS = {
    "xgboost_poisson": BO.Params(500, 0.03, "depth", depth=3, l2=1.0, min_hessian=1.0, rows=0.85, columns=0.85,
                                 poisson=True, hessian_shift=0.7, max_value=0.7),
    "lightgbm_poisson": BO.Params(700, 0.03, "leaf", leaves=31, l2=0.0, min_rows=20, min_hessian=1e-3, rows=0.85, columns=0.85,
                                  poisson=True, hessian_shift=0.7),
    "catboost_poisson": BO.Params(500, 0.03, "symmetric", depth=4, l2=3.0, poisson=True),
}


def boosting_params(preset: str, **given) -> BO.Params:
    """A preset's settings, with grid parameters in place of its own."""
    return BO.adjusted((POISSON_PRESETS if preset in POISSON_PRESETS else GBT_PRESETS)[preset], **given)


def boosting_dataset(train: DataFrame, pre: Preprocessor, y: str = "count") -> BO.Dataset:
    """Binned training rows: filled columns, target, and a hash of the row's key (of all columns where it has none)."""
    key = [*C.KEY_COLS, "yearweek"]
    key = key if set(key) <= set(train.columns) else train.columns
    target = F.col(y).cast("double")
    data = train.where(F.col(y).isNotNull())
    numbers = pre.filled_numbers()
    edges = BO.quantile_edges(data.select(*[x.alias(f"x{j}") for j, x in enumerate(numbers)]), [f"x{j}" for j in range(len(numbers))])
    n, mean, positive = data.agg(F.count(F.lit(1)), F.avg(target), F.avg(F.greatest(target, F.lit(0.0)))).first()
    levels = [pre.levels[c] for c in pre.categorical]
    rows = data.select(*(c.alias(n_) for c, n_ in zip(pre.filled(), ("_numbers", "_names"))), target.alias("_y"), F.xxhash64(*key).alias("_key"))
    return BO.Dataset(rows, BO.Layout(edges, levels), n, mean or 0.0, positive or 0.0)


def fit_boosted(jobs: list[tuple], numeric, categorical, y: str = "count", seed: int = C.SEED) -> list[BoostedModel]:
    """MOD-4 / MOD-5: ensembles in lock step, one per job (key, training rows, preprocessing or None, settings).

    Jobs with the same key share their rows and bins.
    """
    pres, datasets = {}, {}
    for key, train, pre, _ in jobs:
        if key not in datasets:
            pres[key] = pre or fit_preprocess(train.where(F.col(y).isNotNull()), numeric, categorical)
            datasets[key] = boosting_dataset(train, pres[key], y)
    made = BO.fit_all(datasets, [(key, p) for key, _, _, p in jobs], seed)
    return [BoostedModel(pres[key], m) for (key, *_), m in zip(jobs, made)]


def fit_gbt(train: DataFrame, numeric, categorical, y: str = "count", preset: str = "lightgbm", seed: int = C.SEED,
            pre: Preprocessor | None = None, **given) -> BoostedModel:
    """MOD-4 / MOD-5: one boosted model by its preset (grid parameters override it)."""
    return fit_boosted([(0, train, pre, boosting_params(preset, **given))], numeric, categorical, y, seed)[0]


def fit_poisson_boost(train: DataFrame, numeric, categorical, y: str = "count", preset: str = "lightgbm_poisson",
                      seed: int = C.SEED, pre: Preprocessor | None = None, **given) -> BoostedModel:
    """MOD-5: second-order boosting of the Poisson log-likelihood; predictions are exp(score)."""
    return fit_gbt(train, numeric, categorical, y, preset, seed, pre, **given)


# ---------------------------------------------------------------------------
# MOD-8 / MOD-9: registry
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class ModelSpec:
    name: str
    scope: str  # "naive" or "global_panel"
    fit: Callable | None  # fit(train, numeric, categorical, y) -> model with predict()
    enabled: bool = True
    preset: str | None = None  # of a boosted model; these are fitted together
    linear: dict | None = None  # penalties of a linear model; these come from the same sums


def build_registry(model_task: str = "default") -> list[ModelSpec]:
    """MOD-8: the model pool of a task; iteration counts come from the presets and the grid alone."""
    ev = model_task in C.EV_TASKS

    def linear(name, enabled=True, **penalty):
        return ModelSpec(name, "global_panel", lambda tr, num, cat, y="count", **kw: fit_linear(tr, num, cat, y, **{**penalty, **kw}),
                         enabled, linear=penalty)

    def boosted(preset):
        return ModelSpec(preset, "global_panel", lambda tr, num, cat, y="count", **kw: fit_gbt(tr, num, cat, y, preset, **kw), preset=preset)

    reg = [
        ModelSpec("seasonal_naive", "naive", None),
        linear("ridge", alpha=1.0),
        linear("elasticnet", enabled=not ev, alpha=0.02, l1_ratio=0.15),
        *(boosted(preset) for preset in (*GBT_PRESETS, *POISSON_PRESETS)),
    ]
    if model_task == "rods_ev_national":
        reg = [s for s in reg if s.name in ("seasonal_naive", "ridge") or s.name.endswith("_poisson")]
    return reg


def resolve_allowed_registry(model_task: str, model_names) -> list[ModelSpec]:
    """MOD-9: run-mode models ∩ registry; EV tasks drop ridge and add the Poisson models; fewer than 2 is an error."""
    allowed = set(model_names) - {"keras_mlp", "sarimax"}
    if model_task in C.EV_TASKS:
        allowed.discard("ridge")
        allowed |= {"xgboost_poisson", "lightgbm_poisson", "catboost_poisson"}
    reg = [s for s in build_registry(model_task) if s.name in allowed and s.enabled]
    if len(reg) < 2:
        raise RuntimeError(f"task {model_task} is left with {len(reg)} usable models; two are the least")
    return reg


def fit_with_constant_guard(spec: ModelSpec, train: DataFrame, numeric, categorical, y: str = "count", **params):
    """MOD-7 guard: a constant target gets a constant model instead of the estimator."""
    const = constant_target(train, y)
    if const is not None:
        return ConstantModel(const)
    return spec.fit(train, numeric, categorical, y, **params)


# ---------------------------------------------------------------------------
# CV-3: grid search with the tuning WAPE
# ---------------------------------------------------------------------------
def grid_candidates(model_name: str) -> list[dict]:
    grid = C.PARAM_GRIDS.get(model_name, {})
    combos = [{}]
    for k, vals in grid.items():
        combos = [{**c, k: v} for c in combos for v in vals]
    return combos if grid else []


def _inner_folds(train: DataFrame, n_splits: int) -> list[tuple[list[int], DataFrame]]:
    """CV-2: training weeks and validation rows of the tuning folds."""
    from panelcast.operators.splits import distinct_weeks, inner_splits

    return [(tr, train.where(F.col("yearweek").isin(*va))) for tr, va in inner_splits(distinct_weeks(train), n_splits)]


def _best_candidate(cands: list[dict], folds, models: list[list], y: str) -> dict:
    """The candidate with the least mean tuning WAPE (the first of equal ones); a fold's candidates are scored in one pass."""
    from panelcast.functions.metrics import wape_tuning

    scores = np.zeros(len(cands))
    for (_, valid), fitted in zip(folds, models):
        wide = valid
        for k, m in enumerate(fitted):
            wide = m.predict(wide, f"_p{k}")
        scores += np.array(wide.agg(*[wape_tuning(y, f"_p{k}").alias(f"w{k}") for k in range(len(cands))]).first(), float)
    return cands[int(np.argmin(scores))]


def grid_search(train: DataFrame, specs, numeric, categorical, y: str = "count", n_splits: int = 3,
                candidates: dict | None = None) -> dict[str, dict]:
    """CV-3: best parameters per model, by sum|e|/sum|y| (0 when the denominator is 0) averaged over inner time folds.

    All candidates of all boosted models on all folds grow in lock step; those of
    all linear models come from one aggregation of sums. Models without a grid are
    left out; without folds, or when the search fails (a warning), so are all, and
    they keep their own settings.
    """
    grids = {s.name: c for s in specs if (s.preset or s.linear is not None) and (c := (candidates or {}).get(s.name) or grid_candidates(s.name))}
    by_name = {s.name: s for s in specs}
    try:
        folds = _inner_folds(train, n_splits) if grids else []
        if not folds:
            return {}
        groups = {i: weeks for i, (weeks, _) in enumerate(folds)}
        pres, fixed = group_preprocess(train, groups, numeric, categorical, y)
        made = {(name, i): [ConstantModel(v) for _ in grids[name]] for name in grids for i, v in fixed.items()}
        jobs, owner = [], []
        for i in pres:
            rows = train.where(F.col("yearweek").isin(*groups[i]))
            for name, cands in grids.items():
                if by_name[name].preset:
                    jobs += [(i, rows, pres[i], boosting_params(by_name[name].preset, **c)) for c in cands]
                    owner += [(name, i)] * len(cands)
        for key, m in zip(owner, fit_boosted(jobs, numeric, categorical, y)):
            made.setdefault(key, []).append(m)
        linear = [name for name in grids if not by_name[name].preset]
        eqs = group_equations(train, groups, pres, y) if linear else {}
        for i, eq in eqs.items():
            for name in linear:
                start, out = None, {}
                # from the strongest penalty to the weakest, each from the solution before
                penalties = [{**by_name[name].linear, **c} for c in grids[name]]
                for k in sorted(range(len(penalties)), key=lambda k: (penalties[k].get("l1_ratio", 0.0), -penalties[k]["alpha"])):
                    start = eq.solve(penalties[k]["alpha"], penalties[k].get("l1_ratio", 0.0), start)
                    out[k] = LN.LinearModel.of(pres[i], eq, start)
                made[name, i] = [out[k] for k in range(len(penalties))]
        return {name: _best_candidate(cands, folds, [made[name, i] for i in range(len(folds))], y) for name, cands in grids.items()}
    except Exception as e:  # noqa: BLE001
        warnings.warn(f"grid search failed, the models keep their own settings: {type(e).__name__}: {e}", stacklevel=2)
        return {}


def fit_with_grid_search(spec: ModelSpec, train: DataFrame, numeric, categorical, y: str = "count",
                         n_splits: int = 3, candidates: list[dict] | None = None):
    """CV-3 + MOD-7 for one model: its best candidate (None: its own settings) fitted on all rows; a constant target gets a
    constant model."""
    const = constant_target(train, y)
    if const is not None:
        return ConstantModel(const), None
    best = grid_search(train, [spec], numeric, categorical, y, n_splits, {spec.name: candidates} if candidates else None).get(spec.name)
    return spec.fit(train, numeric, categorical, y, **(best or {})), best

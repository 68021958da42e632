"""Regression combiners ("stacking") and the combiner router (COM-1, COM-6..11, CV-6, CV-7).

Meta features are the base models' predictions (a handful of columns);
the fits are Spark ML linear models, and the non-negative least squares
solve runs on the k x k Gram matrix aggregated by Spark.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast import config as C
from panelcast.functions.medians import exact_medians
from panelcast.functions.metrics import finite
from panelcast.operators import combine as CB
from panelcast.operators import splits as SP
from panelcast.operators.linear import LinearModel
from panelcast.operators.models import ConstantModel, fit_linear, group_equations, group_preprocess


#: Penalties of the combiners that are solved from sums of products.
PENALTIES = {"ridge": {"alpha": 1.0}, "elasticnet": {"alpha": 0.01, "l1_ratio": 0.25}, "lasso": {"alpha": 0.01, "l1_ratio": 1.0}}


@dataclass
class NNLSModel:
    """COM-10: y ~ b + X w with w >= 0 (no scaling)."""

    cols: list
    coef: np.ndarray
    intercept: float

    def predict(self, df: DataFrame, out: str = "y_pred") -> DataFrame:
        expr = F.lit(self.intercept)
        for c, w in zip(self.cols, self.coef):
            expr = expr + F.lit(float(w)) * F.col(c)
        return df.withColumn(out, expr)


def _nnls_gram(A: np.ndarray, b: np.ndarray, iters: int = 20000, tol: float = 1e-13) -> np.ndarray:
    """min 1/2 w'Aw - b'w subject to w >= 0, by cyclic coordinate descent (k is tiny)."""
    w = np.zeros(len(b))
    for _ in range(iters):
        delta = 0.0
        for j in range(len(b)):
            if A[j, j] <= 0:
                continue
            new = max(0.0, w[j] - (A[j] @ w - b[j]) / A[j, j])
            delta = max(delta, abs(new - w[j]))
            w[j] = new
        if delta < tol:
            return w
    raise RuntimeError(f"non-negative least squares did not settle in {iters} sweeps")


def fit_nnls(train: DataFrame, cols, y: str = "y_true") -> NNLSModel:
    k = len(cols)
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(y).alias("my")] + [F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]
    r = train.agg(*aggs).first()
    n, my = r["n"], r["my"]
    means = [r[f"m{i}"] for i in range(k)]
    cen = [(F.col(c) - F.lit(means[i])) for i, c in enumerate(cols)]
    yc = F.col(y) - F.lit(my)
    g = train.agg(*[F.sum(cen[i] * cen[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)],
                  *[F.sum(cen[i] * yc).alias(f"b{i}") for i in range(k)]).first()
    A = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            A[i, j] = A[j, i] = g[f"g{i}_{j}"]
    b = np.array([g[f"b{i}"] for i in range(k)])
    w = _nnls_gram(A, b)
    return NNLSModel(list(cols), w, float(my - np.dot(means, w)))


@dataclass
class MetaModel:
    method: str
    cols: list
    model: object  # fitted regression model, or rule-based weights DataFrame


def fit_combiner(matrix: DataFrame, model_cols, method: str, y: str = "y_true", topk: int | None = None) -> MetaModel:
    """COM-1 + COM-13: complete cases, then a rule-based weight table or a regression meta model."""
    m = str(method).lower().strip()
    fit = CB.complete_cases(matrix, model_cols, y)
    if fit.isEmpty():
        raise RuntimeError(f"{m}: no row has the target and every base prediction")
    if m in C.RULE_BASED_METHODS:
        long = CB.melt(fit, [y], model_cols).withColumnRenamed(y, "y_true")
        return MetaModel(m, list(model_cols), CB.rule_weights(long, m, topk))
    data = fit.select(*[finite(c).alias(c) for c in model_cols], F.col(y).cast("double").alias("_y"))
    if m in PENALTIES:
        model = fit_linear(data, model_cols, [], "_y", **PENALTIES[m])
    elif m == "huber":
        model = fit_linear(data, model_cols, [], "_y", alpha=1e-4, loss="huber", epsilon=1.35)
    elif m == "nonnegative_linear":
        model = fit_nnls(data, model_cols, "_y")
    else:
        raise ValueError(f"no combiner is called {method!r}")
    return MetaModel(m, list(model_cols), model)


def gap_medians(df: DataFrame, cols) -> dict:
    """Medians of the columns with gaps (None for the others, which need none); one count finds the gaps."""
    cols = list(cols)
    gaps = df.agg(*[F.count_if(finite(F.col(c).cast("double")).isNull()).alias(c) for c in cols]).first() if cols else {}
    missing = [c for c in cols if gaps[c]]
    return dict.fromkeys(cols) | exact_medians(df, missing)


def predict_combiner(meta: MetaModel, matrix: DataFrame, id_cols) -> DataFrame:
    """COM-5 / COM-11: align columns, impute median then 0 over the predicted batch, predict, clip at 0."""
    for c in meta.cols:
        if c not in matrix.columns:
            matrix = matrix.withColumn(c, F.lit(None).cast("double"))
    if isinstance(meta.model, DataFrame):
        return CB.apply_weights(matrix, meta.model, meta.cols, id_cols)
    med = gap_medians(matrix, meta.cols)
    filled = matrix.select(*id_cols, *[F.coalesce(finite(c), F.lit(med[c]), F.lit(0.0)).alias(c) for c in meta.cols])
    out = meta.model.predict(filled, "y_pred")
    return out.select(*id_cols, F.greatest(F.col("y_pred"), F.lit(0.0)).alias("y_pred"))


def _fold_metas(valid: DataFrame, model_cols, method: str, y: str, weeks: list[list[int]]) -> dict:
    """Regression combiners of all folds from one aggregation: {fold: MetaModel}."""
    data = valid.select("yearweek", *[finite(c).alias(c) for c in model_cols], F.col(y).cast("double").alias("_y"))
    groups = dict(enumerate(weeks))
    pres, fixed = group_preprocess(data, groups, model_cols, [], "_y")
    eqs = group_equations(data, groups, pres, "_y")
    out = {i: MetaModel(method, list(model_cols), LinearModel.of(pres[i], eq, eq.solve(**PENALTIES[method]))) for i, eq in eqs.items()}
    return out | {i: MetaModel(method, list(model_cols), ConstantModel(v)) for i, v in fixed.items() if weeks[i]}


def meta_oof(matrix: DataFrame, model_cols, method: str, id_cols, n_splits: int, y: str = "y_true",
             topk: int | None = None) -> tuple[DataFrame, str]:
    """CV-6 / CV-7: honest rolling OOF of a combiner over the stack-valid rows; falls back to in-sample."""
    m = str(method).lower().strip()
    if m in C.RULE_BASED_METHODS:
        return CB.meta_oof_rule(matrix, model_cols, m, id_cols, n_splits, y, topk)
    valid = CB.complete_cases(matrix, model_cols, y)
    try:
        splits = SP.rolling_splits(SP.distinct_weeks(valid), max(2, min(n_splits, 5)), 12)
    except RuntimeError:
        splits = []
    parts, failed = [], []
    fitted = _fold_metas(valid, model_cols, m, y, [tr for tr, _ in splits]) if splits and m in PENALTIES else {}
    for i, (tr, va) in enumerate(splits):
        try:
            meta = fitted[i] if m in PENALTIES else fit_combiner(valid.where(F.col("yearweek").isin(*tr)), model_cols, m, y, topk)
            parts.append(predict_combiner(meta, valid.where(F.col("yearweek").isin(*va)), id_cols))
        except (RuntimeError, ValueError, KeyError):
            failed.append(i)  # stays without prediction; the evaluation's name says so
    if parts:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        missing = f" without folds {', '.join(map(str, failed))}" if failed else ""
        return out, "rolling_meta_oof" + missing
    meta = fit_combiner(valid, model_cols, m, y, topk)
    return predict_combiner(meta, valid, id_cols), "insample_meta"


def combiner_weights(meta: MetaModel) -> DataFrame | None:
    """COM-12: (meta_model, base_model, weight): a rule's weights, or the coefficients of a regression combiner
    (on standardised predictions, non-negative ones on the predictions as they are); None for a constant."""
    if isinstance(meta.model, DataFrame):
        return CB.extract_weights(meta.model, meta.method)
    if isinstance(meta.model, NNLSModel):
        coef = [float(w) for w in meta.model.coef]
    elif isinstance(meta.model, LinearModel):
        coef = [float(w) for w in meta.model.coef]
    elif hasattr(meta.model, "model"):
        coef = [float(w) for w in meta.model.model.coefficients.toArray()]
    else:
        return None
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(
        [(meta.method, c, w) for c, w in zip(meta.cols, coef)], "meta_model string, base_model string, weight double"
    )

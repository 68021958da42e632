"""Rule-based combiners over base-model predictions (COM-2..5, COM-12, COM-13, AGG-8, AGG-11, AGG-16, SRT-6, CV-6, FIL-12, FIL-13).

Weights are a tiny frame (groups x models, where a group is e.g. a fold),
fitted on the long form ``(group..., id..., model_name, y_pred)``; applying them
is one expression over the wide prediction matrix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast import config as C
from panelcast.functions.medians import exact_medians
from panelcast.functions.metrics import finite, wape_weighting
from panelcast.operators import splits as SP


def drop_empty_models(matrix: DataFrame, model_cols) -> list[str]:
    """FIL-12: the model columns that have at least one prediction (one aggregate, n models values)."""
    row = matrix.agg(*[F.count(finite(c)).alias(c) for c in model_cols]).first()
    return [c for c in model_cols if row[c] > 0]


def complete_cases(matrix: DataFrame, model_cols, y: str = "y_true") -> DataFrame:
    """COM-13 / FIL-13: rows where the truth and every model prediction are present and finite."""
    cond = finite(y).isNotNull()
    for c in model_cols:
        cond = cond & finite(c).isNotNull()
    return matrix.where(cond)


def melt(matrix: DataFrame, id_cols, model_cols, keep_missing: bool = True) -> DataFrame:
    """Wide matrix -> long, with each model's position (column order) for stable tie-breaks."""
    pos = F.create_map(*[x for i, c in enumerate(model_cols) for x in (F.lit(c), F.lit(i))])
    long = matrix.select(*id_cols, *[finite(c).cast("double").alias(c) for c in model_cols]).unpivot(
        list(id_cols), list(model_cols), "model_name", "y_pred"
    )
    long = long.withColumn("_model_pos", pos[F.col("model_name")])
    return long if keep_missing else long.where(F.col("y_pred").isNotNull())


def rule_weights(long_fit: DataFrame, method: str, topk: int | None = None, group_cols=()) -> DataFrame:
    """COM-2..4 (+ AGG-8, AGG-16, SRT-6): weights per (group, model) from complete-case fit rows.

    ``long_fit``: group_cols + model_name + _model_pos + y_true + y_pred.
    Returns group_cols + model_name + _model_pos + wape + weight.
    """
    method = str(method).lower().strip()
    if method not in C.RULE_BASED_METHODS:
        raise ValueError(f"{method!r} is not a rule-based combiner; choose one of {sorted(C.RULE_BASED_METHODS)}")
    g = list(group_cols)
    per = long_fit.groupBy(*g, "model_name", "_model_pos").agg(wape_weighting("y_true", "y_pred").alias("wape"))
    wg = Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))
    n = F.count(F.lit(1)).over(wg)
    if method == "simple_average":
        weight = F.lit(1.0) / n
    elif method == "weighted_average":
        inv = F.when(F.col("wape") != float("inf"), F.lit(1.0) / F.greatest(F.col("wape"), F.lit(1e-6))).otherwise(F.lit(0.0))
        per = per.withColumn("_inv", inv)
        total = F.sum("_inv").over(wg)
        weight = F.when(total > 0, F.col("_inv") / total).otherwise(F.lit(1.0) / n)
    else:
        k = max(1, int(topk or C.DEFAULT_ENSEMBLE_TOPK))
        kk = F.least(F.lit(k), n)
        rank = F.row_number().over(wg.orderBy(F.col("wape"), F.col("_model_pos")))
        weight = F.when(rank <= kk, F.lit(1.0) / kk).otherwise(F.lit(0.0))
    return per.select(*g, "model_name", "_model_pos", "wape", weight.alias("weight"))


def apply_weights(matrix: DataFrame, weights: DataFrame, model_cols, id_cols, group_cols=()) -> DataFrame:
    """COM-5 (+ AGG-11, MOD-11, SCA-9): weighted sum per row, in model order; a missing prediction takes its
    column's median over the predicted batch (of its group), then 0; the result is clipped at 0.

    The weights (one per group and model, bounded by folds x models) become
    literals of one expression over the wide matrix: no melt, join or shuffle.
    """
    g = list(group_cols)
    rows = weights.select(*g, "model_name", "weight").collect()
    cols = [c for c in model_cols if any(r["model_name"] == c for r in rows)]
    groups = sorted({tuple(r[k] for k in g) for r in rows})
    some = matrix.select(*g, *id_cols, *[finite(c).cast("double").alias(c) for c in cols])
    gaps = some.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    missing = [c for c in cols if gaps[c]]

    def per_group(value):
        """One literal per group; the only one without groups."""
        out = F.lit(None).cast("double")
        for key in groups:
            hit = F.lit(True)
            for k, v in zip(g, key):
                hit = hit & (F.col(k) == F.lit(v))
            out = F.when(hit, F.lit(value(key)).cast("double")).otherwise(out)
        return out

    medians = {}
    for key in groups if missing else []:
        part = some
        for k, v in zip(g, key):
            part = part.where(F.col(k) == F.lit(v))
        medians[key] = exact_medians(part, missing)
    given = {(tuple(r[k] for k in g), r["model_name"]): r["weight"] for r in rows}
    total = F.lit(0.0)
    for c in cols:
        filled = F.coalesce(F.col(c), per_group(lambda key, c=c: medians[key][c]), F.lit(0.0)) if c in missing else F.col(c)
        total = total + filled * per_group(lambda key, c=c: given.get((key, c), 0.0))
    return some.select(*g, *id_cols, F.greatest(total, F.lit(0.0)).alias("y_pred")).where(F.col("y_pred").isNotNull())


def fit_predict_rule(matrix_fit: DataFrame, matrix_pred: DataFrame, model_cols, method: str, id_cols,
                     y: str = "y_true", topk: int | None = None, group_cols=()) -> tuple[DataFrame, DataFrame]:
    """Fit weights on complete-case rows of ``matrix_fit`` and predict ``matrix_pred``. Returns (weights, predictions)."""
    fit = complete_cases(matrix_fit, model_cols, y)
    long_fit = melt(fit, [*group_cols, y], model_cols).withColumnRenamed(y, "y_true")
    w = rule_weights(long_fit, method, topk, group_cols)
    return w, apply_weights(matrix_pred, w, model_cols, id_cols, group_cols)


def meta_oof_rule(matrix: DataFrame, model_cols, method: str, id_cols, n_splits: int, y: str = "y_true",
                  topk: int | None = None, min_train_weeks: int = 12) -> tuple[DataFrame, str]:
    """CV-6 for rule-based combiners: rolling folds over the stack-valid rows' weeks, weights per fold.

    Returns (predictions keyed by id_cols with ``y_pred``, meta_eval_type). When no
    fold can be built, falls back to fitting and predicting all rows (``insample_meta``).
    """
    valid = complete_cases(matrix, model_cols, y)
    weeks = SP.distinct_weeks(valid)
    try:
        splits = SP.rolling_splits(weeks, max(2, min(n_splits, 5)), min_train_weeks)
    except RuntimeError:
        splits = []
    if splits:
        folds = SP.fold_table(matrix.sparkSession, splits)
        fit = SP.assign_folds(valid, folds, "train")
        pred = SP.assign_folds(valid, folds, "valid")
        _, out = fit_predict_rule(fit, pred, model_cols, method, id_cols, y, topk, ["fold"])
        return out.drop("fold"), "rolling_meta_oof"
    _, out = fit_predict_rule(valid, valid, model_cols, method, id_cols, y, topk)
    return out, "insample_meta"


def extract_weights(weights: DataFrame, method: str) -> DataFrame:
    """COM-12: (meta_model, base_model, weight)."""
    return weights.select(F.lit(method).alias("meta_model"), F.col("model_name").alias("base_model"), "weight")

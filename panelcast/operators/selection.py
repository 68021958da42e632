"""Feature profile and selection (AGG-9, AGG-10, AGG-11, SEL-1..3, SRT-5, JOI-12, COL-19).

Statistics are computed in Spark over the (panel-sized) training rows; the
keep/drop decision over a few tens of column names runs on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast import config as C
from panelcast.functions.medians import exact_medians
from panelcast.functions.metrics import finite
from panelcast.operators.boosting import Params, fit_all


@dataclass(frozen=True)
class SelectionResult:
    numeric_cols: list[str]
    report: DataFrame


def profile_features(df: DataFrame, numeric_cols) -> DataFrame:
    """AGG-9: per feature dtype, missing rate, zero rate (missing counts as zero), distinct count, mean, sample std, min, max.

    Runs in long form, so the distinct count is one grouped aggregation over (feature, value).
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    cols = list(numeric_cols)
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "feature", "v")
    prof = long.groupBy("feature").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("v").isNull() | F.isnan("v")).alias("_miss"),
        F.count_if(F.coalesce(F.col("v"), F.lit(0.0)) == 0).alias("_zero"),
        F.count_distinct(F.when(~F.isnan("v"), F.col("v"))).alias("n_unique"),
        F.avg(finite("v")).alias("mean"),
        F.stddev_samp(finite("v")).alias("std"),
        F.min(finite("v")).alias("min"),
        F.max(finite("v")).alias("max"),
    )
    dtype = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c]))])
    return prof.select(
        "feature", dtype[F.col("feature")].alias("dtype"),
        (F.col("_miss") / F.col("_n")).alias("missing_rate"),
        (F.col("_zero") / F.col("_n")).alias("zero_rate"),
        "n_unique", "mean", "std", "min", "max",
    )


def column_medians(df: DataFrame, cols) -> dict:
    """AGG-11: exact medians (NaN and inf ignored); a column with no values gets None."""
    return exact_medians(df, cols)


def impute(df: DataFrame, medians: dict) -> DataFrame:
    """Median imputation as ``coalesce``; inf/NaN count as missing (COL-19)."""
    return df.select(*[
        F.coalesce(finite(c), F.lit(medians[c])).alias(c) if c in medians and medians[c] is not None else F.col(c)
        for c in df.columns
    ])


def correlation_matrix(df: DataFrame, cols) -> np.ndarray:
    """AGG-10: Pearson correlation of the given (imputed, non-constant) columns via Spark ML statistics."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    vec = VectorAssembler(inputCols=list(cols), outputCol="_f", handleInvalid="keep").transform(df.select(*cols))
    return Correlation.corr(vec, "_f", "pearson").first()[0].toArray()


def pair_correlations(df: DataFrame, cols) -> DataFrame:
    """AGG-10 as a table: (feature_a, feature_b, corr) for every pair, NULL when a side is constant.

    One aggregate of population covariances and standard deviations (no
    division error on constant columns).
    """
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    row = df.agg(*[F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)).alias(f"{a}|{b}") for a, b in pairs]).first()
    spark = df.sparkSession
    return spark.createDataFrame([(a, b, row[f"{a}|{b}"]) for a, b in pairs], "feature_a string, feature_b string, corr double")


def filter_numeric_features(train: DataFrame, numeric_cols, missing_threshold: float = 0.90,
                            corr_threshold: float = 0.98) -> SelectionResult:
    """SEL-2: missing-rate and distinct filters, mandatory features kept, zero-variance and near-duplicate removal."""
    profile = profile_features(train, numeric_cols)
    prof = {r.feature: r for r in profile.collect()}
    keep = [c for c in numeric_cols if prof[c].missing_rate <= missing_threshold and prof[c].n_unique > 1]
    mandatory = [c for c in numeric_cols if c in C.MANDATORY_NUMERIC_FEATURES]
    # an entirely missing feature cannot be imputed: drop it even when mandatory
    mandatory = [c for c in mandatory if prof[c].missing_rate < 1.0]
    keep = list(dict.fromkeys(mandatory + keep))
    if keep:
        med = column_medians(train, keep)
        x = impute(train.select(*keep), med)
        var = x.agg(*[F.var_pop(c).alias(c) for c in keep]).first()
        vt = [c for c in keep if var[c] is not None and var[c] > 0]
        keep = list(dict.fromkeys(mandatory + vt))
        if len(keep) > 1:
            corr = np.abs(correlation_matrix(x, keep))
            drop = set()
            for j, col in enumerate(keep):
                if col in mandatory:
                    continue
                if any(corr[i, j] > corr_threshold for i in range(j)):
                    drop.add(col)
            keep = [c for c in keep if c not in drop]
    report = profile.select(
        "*", F.col("feature").isin(*keep).alias("selected") if keep else F.lit(False).alias("selected"),
        F.lit("filter").alias("selection_stage"), F.lit(None).cast("double").alias("importance"),
    )
    return SelectionResult(keep, report)


#: The model whose split counts rank the features.
RANKING = Params(250, 0.05, "leaf", leaves=31, l2=0.0, min_rows=20, min_hessian=1e-3, rows=0.85, columns=0.85)


def importance_topk(train: DataFrame, numeric_cols, target_col: str = "count", top_k: int = 60,
                    max_iter: int | None = None, seed: int = C.SEED) -> SelectionResult:
    """SEL-3: filter, then how often a boosted model splits on each feature; top k ∪ mandatory (ties by name)."""
    from panelcast.operators.models import Preprocessor, boosting_dataset

    filtered = filter_numeric_features(train, numeric_cols)
    cand = filtered.numeric_cols
    data = train.where(F.col(target_col).isNotNull())
    if not cand or data.isEmpty():
        return filtered
    pre = Preprocessor(cand, [], column_medians(data, cand), {}, {})
    booster = fit_all({0: boosting_dataset(data, pre, target_col)}, [(0, replace(RANKING, iterations=max_iter or RANKING.iterations))], seed)[0]
    ranked = sorted(zip(cand, booster.split_counts().tolist()), key=lambda t: (-t[1], t[0]))
    mandatory = [c for c in cand if c in C.MANDATORY_NUMERIC_FEATURES]
    selected = list(dict.fromkeys(mandatory + [c for c, _ in ranked[:top_k]]))
    imp_df = train.sparkSession.createDataFrame([(c, float(v)) for c, v in ranked], "feature string, importance double")
    prof = filtered.report.drop("selected", "selection_stage", "importance")
    report = prof.join(F.broadcast(imp_df), "feature", "left").select(
        *prof.columns, F.coalesce("importance", F.lit(0.0)).alias("importance"),
        F.col("feature").isin(*selected).alias("selected"), F.lit("lgbm_topk").alias("selection_stage"),
    )
    return SelectionResult(selected, report)


def select_features(train: DataFrame, numeric_cols, method: str, top_k: int | None = None, **kw) -> SelectionResult:
    """SEL-1: dispatch none / filter / lgbm_topk."""
    if method == "none":
        spark = train.sparkSession
        rep = spark.createDataFrame([(c,) for c in numeric_cols], "feature string").select(
            "feature", F.lit(True).alias("selected"), F.lit("none").alias("selection_stage"),
            F.lit(None).cast("double").alias("importance"))
        return SelectionResult(list(numeric_cols), rep)
    if method == "filter":
        return filter_numeric_features(train, numeric_cols)
    if method == "lgbm_topk":
        return importance_topk(train, numeric_cols, top_k=top_k or 60, **kw)
    raise ValueError(f"features cannot be selected by {method!r}")

"""Metric expressions (AGG-4, AGG-7, AGG-8, FIL-11, FIL-15) as built-in aggregate columns.

Every function returns Columns that can be placed in one ``agg`` so a whole
metric row is one hash aggregate (partial + final), never a Python loop.
"""

from __future__ import annotations

from pyspark.sql import functions as F

METRIC_NAMES = ["MAE", "RMSE", "MAPE", "sMAPE", "WAPE", "Bias", "Pearson", "HitRate",
                "y_true_sum", "y_pred_sum", "y_true_mean", "y_pred_mean"]


def finite(col) -> F.Column:
    """COL-19: NULL for NaN and +-inf."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(~(F.isnan(c) | (F.abs(c) == float("inf"))), c)


def valid_pair(y: str = "y_true", p: str = "y_pred") -> F.Column:
    """FIL-11: truth and prediction both present and finite."""
    return finite(y).isNotNull() & finite(p).isNotNull()


def metric_aggs(y: str = "y_true", p: str = "y_pred", hit: str | None = "_hit") -> list[F.Column]:
    """AGG-4: n_obs + the 12 regression metrics over already-valid rows."""
    yt, yp = F.col(y), F.col(p)
    err = yp - yt
    ae = F.abs(err)
    sy, sp = F.sum(yt), F.sum(yp)
    n = F.count(F.lit(1))
    sdy, sdp = F.stddev_pop(yt), F.stddev_pop(yp)
    denom = F.abs(yt) + F.abs(yp)
    pearson = F.when((n >= 2) & (sdy > 0) & (sdp > 0), F.try_divide(F.covar_pop(yt, yp), sdy * sdp))
    return [
        n.alias("n_obs"),
        F.avg(ae).alias("MAE"),
        F.sqrt(F.avg(err * err)).alias("RMSE"),
        F.avg(F.when(yt != 0, ae / F.abs(yt))).alias("MAPE"),
        F.avg(F.when(denom != 0, 2 * ae / denom)).alias("sMAPE"),
        F.when(sy != 0, F.try_divide(F.sum(ae), F.abs(sy))).alias("WAPE"),
        F.when(sy != 0, F.try_divide(sp - sy, sy)).alias("Bias"),
        pearson.alias("Pearson"),
        (F.avg(F.col(hit)) if hit else F.lit(None).cast("double")).alias("HitRate"),
        sy.cast("double").alias("y_true_sum"),
        sp.cast("double").alias("y_pred_sum"),
        F.avg(yt).alias("y_true_mean"),
        F.avg(yp).alias("y_pred_mean"),
    ]


def wape_tuning(y: str = "y_true", p: str = "y_pred") -> F.Column:
    """AGG-7: sum|e| / sum|y|, 0 when the denominator is 0 (scorer used for tuning)."""
    den = F.sum(F.abs(F.col(y)))
    return F.when(den == 0, F.lit(0.0)).otherwise(F.try_divide(F.sum(F.abs(F.col(p) - F.col(y))), den))


def wape_weighting(y: str = "y_true", p: str = "y_pred") -> F.Column:
    """AGG-8: sum|e| / sum|y|, +inf when the denominator is 0 (ensemble weights)."""
    den = F.sum(F.abs(F.col(y)))
    return F.when(den == 0, F.lit(float("inf"))).otherwise(F.try_divide(F.sum(F.abs(F.col(p) - F.col(y))), den))

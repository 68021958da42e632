import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators.models import (ConstantModel, build_registry, fit_gbt, fit_linear, fit_poisson_boost,
                                        fit_with_constant_guard, resolve_allowed_registry)


def _data(spark, n=60, seed=3):
    rng = np.random.default_rng(seed)
    x1 = rng.normal(size=n)
    x2 = rng.normal(size=n) * 3 + 1
    y = 2.0 + 1.5 * x1 - 0.7 * x2 + rng.normal(size=n) * 0.3
    rows = [(float(a), float(b), float(c), "k" + str(i % 3), 200001 + i) for i, (a, b, c) in enumerate(zip(x1, x2, y))]
    return spark.createDataFrame(rows, "x1 double, x2 double, count double, grp string, yearweek int"), x1, x2, y


def test_ridge_matches_closed_form(spark):
    df, x1, x2, y = _data(spark)
    X = np.column_stack([x1, x2])
    Z = (X - X.mean(0)) / X.std(0)
    w = np.linalg.solve(Z.T @ Z + 1.0 * np.eye(2), Z.T @ (y - y.mean()))
    exp = y.mean() + Z @ w
    m = fit_linear(df, ["x1", "x2"], [], "count", alpha=1.0)
    got = [r.y_pred for r in m.predict(df).orderBy("yearweek").collect()]
    assert got == pytest.approx(list(exp), abs=1e-6)


def test_linear_with_categorical_and_unknown_level(spark):
    df, *_ = _data(spark)
    m = fit_linear(df, ["x1", "x2"], ["grp"], "count", alpha=0.02, l1_ratio=0.15)
    new = spark.createDataFrame([(0.0, 1.0, None, "unseen", 1)], "x1 double, x2 double, count double, grp string, yearweek int")
    assert np.isfinite(m.predict(new).first().y_pred)


def test_gbt_and_poisson(spark):
    df, *_ = _data(spark)
    g = fit_gbt(df, ["x1", "x2"], [], "count", "xgboost", max_iter=5)
    assert all(np.isfinite(r.y_pred) for r in g.predict(df).collect())
    pos = df.withColumn("count", F.round(F.exp(F.col("x1") * 0.5 + 1)))
    p = fit_poisson_boost(pos, ["x1", "x2"], [], "count", "xgboost_poisson", max_iter=15)
    pred = p.predict(pos).select("count", "y_pred").collect()
    y = np.array([r["count"] for r in pred])
    mu = np.array([r.y_pred for r in pred])

    def dev(m):
        return 2 * np.sum(np.where(y > 0, y * np.log(np.maximum(y, 1e-12) / m), 0) - (y - m))

    assert dev(mu) < dev(np.full_like(y, y.mean()))


def test_constant_guard_and_registry(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0)], "x1 double, count double")
    spec = build_registry()[1]
    m = fit_with_constant_guard(spec, df, ["x1"], [], "count")
    assert isinstance(m, ConstantModel) and m.value == 3.0
    ev = [s.name for s in resolve_allowed_registry("nhi_ev_branch", ["seasonal_naive", "ridge", "lightgbm"])]
    assert "ridge" not in ev and "lightgbm_poisson" in ev and "elasticnet" not in ev
    nat = [s.name for s in build_registry("rods_ev_national")]
    assert set(nat) == {"seasonal_naive", "ridge", "xgboost_poisson", "lightgbm_poisson", "catboost_poisson"}
    with pytest.raises(RuntimeError):
        resolve_allowed_registry("default", ["seasonal_naive"])


def _elastic_net_cd(Z, y, alpha, l1, iters=5000):
    """Plain coordinate descent for 1/(2n)|y - b - Zw|^2 + alpha*l1*|w|_1 + alpha*(1-l1)/2*|w|^2."""
    n, k = Z.shape
    yc = y - y.mean()
    w = np.zeros(k)
    for _ in range(iters):
        for j in range(k):
            r = yc - Z @ w + Z[:, j] * w[j]
            rho = Z[:, j] @ r / n
            w[j] = np.sign(rho) * max(abs(rho) - alpha * l1, 0.0) / (Z[:, j] @ Z[:, j] / n + alpha * (1 - l1))
    return y.mean() + Z @ w


@pytest.mark.parametrize("alpha,l1", [(0.02, 0.15), (0.3, 1.0), (0.5, 0.5)])
def test_elastic_net_matches_coordinate_descent(spark, alpha, l1):
    df, x1, x2, y = _data(spark)
    X = np.column_stack([x1, x2])
    Z = (X - X.mean(0)) / X.std(0)
    exp = _elastic_net_cd(Z, y, alpha, l1)
    m = fit_linear(df, ["x1", "x2"], [], "count", alpha=alpha, l1_ratio=l1)
    got = [r.y_pred for r in m.predict(df).orderBy("yearweek").collect()]
    assert got == pytest.approx(list(exp), abs=1e-4)


def _huber_fit(Z, y, alpha, eps=1.35, iters=20000, lr=0.05):
    """Minimise sum(s + H(r/s) s) + alpha |w|^2 over (w, b, s > 0) by gradient descent (convex in (w, b, s))."""
    n, k = Z.shape
    w, b, s = np.zeros(k), float(np.median(y)), 1.0
    for _ in range(iters):
        r = y - b - Z @ w
        z = r / s
        inner = np.abs(z) <= eps
        dz = np.where(inner, 2 * z, 2 * eps * np.sign(z))  # dH/dz
        gw = -(dz @ Z) + 2 * alpha * w
        gb = -dz.sum()
        # d/ds [s + H(r/s) s] = 1 + H(z) - z H'(z)
        hz = np.where(inner, z * z, 2 * eps * np.abs(z) - eps * eps)
        gs = np.sum(1 + hz - z * dz)
        w -= lr * gw / n
        b -= lr * gb / n
        s = max(s - lr * gs / n, 1e-6)
    return b + Z @ w


def test_huber_matches_direct_minimisation(spark):
    df, x1, x2, y = _data(spark, n=80, seed=9)
    y = y.copy()
    y[::10] += 15.0  # outliers
    rows = [(float(a), float(b), float(c), "k", 200001 + i) for i, (a, b, c) in enumerate(zip(x1, x2, y))]
    df = spark.createDataFrame(rows, "x1 double, x2 double, count double, grp string, yearweek int")
    X = np.column_stack([x1, x2])
    Z = (X - X.mean(0)) / X.std(0)
    exp = _huber_fit(Z, y, alpha=1.0)
    m = fit_linear(df, ["x1", "x2"], [], "count", alpha=1.0, loss="huber", epsilon=1.35)
    got = [r.y_pred for r in m.predict(df).orderBy("yearweek").collect()]
    assert got == pytest.approx(list(exp), abs=2e-2)

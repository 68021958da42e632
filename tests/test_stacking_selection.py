import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast import config as C
from panelcast.operators.models import build_registry, fit_with_grid_search
from panelcast.operators.selection import filter_numeric_features, pair_correlations
from panelcast.operators.stacking import fit_combiner, meta_oof, predict_combiner


def _matrix(spark, n=80, seed=11):
    rng = np.random.default_rng(seed)
    y = rng.uniform(0, 20, n)
    a = y + rng.normal(0, 1, n)
    b = 0.5 * y + rng.normal(0, 3, n)
    rows = [(i, 199001 + i, float(y[i]), float(a[i]), float(b[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id int, yearweek int, y_true double, a double, b double"), y, a, b


def test_nonnegative_stacking_matches_projected_least_squares(spark):
    df, y, a, b = _matrix(spark)
    meta = fit_combiner(df, ["a", "b"], "nonnegative_linear")
    X = np.column_stack([a, b])
    Xc, yc = X - X.mean(0), y - y.mean()
    w, *_ = np.linalg.lstsq(Xc, yc, rcond=None)
    assert (meta.model.coef >= 0).all()
    if (w >= 0).all():
        assert meta.model.coef == pytest.approx(w, abs=1e-6)
    pred = predict_combiner(meta, df, ["id"]).collect()
    assert all(r.y_pred >= 0 for r in pred)


@pytest.mark.parametrize("method", ["ridge", "lasso", "elasticnet", "huber", "simple_average", "topk_average"])
def test_combiners_fit_predict_and_meta_oof(spark, method):
    df, *_ = _matrix(spark)
    meta = fit_combiner(df, ["a", "b"], method)
    missing = df.withColumn("b", F.when(F.col("id") == 3, None).otherwise(F.col("b")))
    out = {r.id: r.y_pred for r in predict_combiner(meta, missing, ["id"]).collect()}
    assert len(out) == 80 and all(v >= 0 for v in out.values())
    pred, kind = meta_oof(df, ["a", "b"], method, ["id", "yearweek"], n_splits=2)
    assert kind == "rolling_meta_oof"
    assert 0 < pred.count() < 80  # only validation weeks of the meta folds


def test_grid_search_picks_a_candidate(spark):
    rng = np.random.default_rng(5)
    rows = [(200001 + i, float(x), float(3 * x + rng.normal())) for i, x in enumerate(rng.normal(size=160))]
    df = spark.createDataFrame(rows, "yearweek int, x double, count double")
    ridge = [s for s in build_registry() if s.name == "ridge"][0]
    model, best = fit_with_grid_search(ridge, df, ["x"], [], "count", n_splits=2)
    assert best in [{"alpha": a} for a in C.PARAM_GRIDS["ridge"]["alpha"]]
    assert model.predict(df).count() == 160


def test_filter_selection_drops_duplicates_keeps_mandatory(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=50)
    rows = [(float(v), float(v * 2), float(rng.normal()), 1.0, None) for v in base]
    df = spark.createDataFrame(rows, "lag_1 double, dup double, other double, const double, empty double")
    res = filter_numeric_features(df, ["lag_1", "dup", "other", "const", "empty"])
    assert res.numeric_cols == ["lag_1", "other"]
    rep = {r.feature: r.selected for r in res.report.collect()}
    assert rep["dup"] is False and rep["lag_1"] is True
    corr = {(r.feature_a, r.feature_b): r["corr"] for r in pair_correlations(df, ["lag_1", "dup", "const"]).collect()}
    assert corr[("lag_1", "dup")] == pytest.approx(1.0) and corr[("lag_1", "const")] is None


def test_task_expansion():
    tasks = C.expand_model_tasks(["nhi_er", "rods", "other"])
    assert [t["model_task"] for t in tasks] == ["nhi_ev_branch", "nhi_non_ev_county", "rods_ev_national", "rods_non_ev", "default"]
    assert C.task_metadata("nhi_ev_branch")["model_scope"] == "branch"
    assert C.combiner_model_name("topk_average") == "ensemble_topk_average"


def test_importance_topk(spark):
    from panelcast.operators.selection import importance_topk

    rng = np.random.default_rng(4)
    rows = []
    for i in range(120):
        a, b, c = rng.normal(size=3)
        rows.append((float(a), float(b), float(c), float(5 * a + 0.1 * rng.normal())))
    df = spark.createDataFrame(rows, "signal double, noise1 double, noise2 double, count double")
    res = importance_topk(df, ["signal", "noise1", "noise2"], top_k=1, max_iter=5)
    assert res.numeric_cols == ["signal"]
    rep = {r.feature: (r.selected, r.importance) for r in res.report.collect()}
    assert rep["signal"][0] and rep["signal"][1] > rep["noise1"][1]

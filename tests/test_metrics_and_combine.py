import math

import pytest
from pyspark.sql import functions as F

from panelcast.functions.metrics import metric_aggs
from panelcast.operators.combine import fit_predict_rule, rule_weights, melt
from panelcast.operators.evaluate import metric_levels
from panelcast.operators.panel import collapse_panel
from panelcast.operators.reports import model_method, rounded_count


def _agg(spark, rows):
    df = spark.createDataFrame(rows, "y_true double, y_pred double, _hit double")
    return df.agg(*metric_aggs()).first()


def test_metric_edge_cases(spark):
    r = _agg(spark, [(0.0, 0.0, None), (0.0, 1.0, 1.0)])
    assert r.WAPE is None and r.Bias is None  # sum of truth 0
    assert r.MAPE is None  # no non-zero truth
    assert r.sMAPE == pytest.approx(2.0)  # the 0/0 row is skipped, 2*1/(0+1) for the other
    assert r.Pearson is None  # constant truth
    r = _agg(spark, [(1.0, 2.0, None), (3.0, 2.0, 0.0)])
    assert r.Pearson is None  # constant prediction
    assert r.HitRate == 0.0
    r = _agg(spark, [(1.0, 2.0, None), (3.0, 5.0, 1.0), (2.0, 2.0, 1.0)])
    assert r.MAE == pytest.approx(1.0)
    assert r.WAPE == pytest.approx(3 / 6)
    assert r.Bias == pytest.approx(3 / 6)
    assert r.RMSE == pytest.approx(math.sqrt(5 / 3))
    assert r.Pearson == pytest.approx(0.8660254)


def test_metric_levels_and_hit(spark):
    rows = [("s", "A", "x", 1, 1.0, 1.0), ("s", "A", "x", 2, 2.0, 3.0), ("s", "A", "x", 3, 1.0, 2.0),
            ("s", "B", "y", 1, 4.0, 4.0), ("s", "B", "y", 2, 4.0, 4.0)]
    df = spark.createDataFrame(rows, "data_source string, disease string, county string, yearweek int, y_true double, y_pred double")
    df = df.withColumn("model_name", F.lit("m"))
    out = {(r.metric_level, r.disease, r.county): r for r in metric_levels(df, ["model_name"]).collect()}
    assert set(k[0] for k in out) == {"overall", "by_disease", "by_county", "by_disease_county"}
    assert out[("overall", "ALL", "ALL")].n_obs == 5
    assert out[("overall", "ALL", "ALL")].HitRate == pytest.approx(1.0)  # up/up, down/down, flat/flat
    assert out[("by_disease", "B", "ALL")].Pearson is None


def test_rule_weights(spark):
    rows = [(10.0, 10.0, 5.0, 0.0), (10.0, 10.0, 5.0, 0.0)]
    df = spark.createDataFrame(rows, "y_true double, a double, b double, c double")
    long = melt(df, ["y_true"], ["a", "b", "c"])
    w = {r.model_name: r.weight for r in rule_weights(long, "weighted_average").collect()}
    inv = {"a": 1 / 1e-6, "b": 1 / 0.5, "c": 1 / 1.0}
    tot = sum(inv.values())
    assert w == pytest.approx({k: v / tot for k, v in inv.items()})
    top = {r.model_name: r.weight for r in rule_weights(long, "topk_average", 2).collect()}
    assert top == {"a": 0.5, "b": 0.5, "c": 0.0}
    simple = {r.model_name: r.weight for r in rule_weights(long, "simple_average").collect()}
    assert simple == pytest.approx({"a": 1 / 3, "b": 1 / 3, "c": 1 / 3})


def test_ensemble_predict_imputes_median_then_zero(spark):
    fit = spark.createDataFrame([(4.0, 4.0, 4.0)], "y_true double, a double, b double")
    pred = spark.createDataFrame([(1, 2.0, None), (2, 4.0, 6.0), (3, 6.0, 8.0), (4, -9.0, -9.0)], "id int, a double, b double")
    _, out = fit_predict_rule(fit, pred, ["a", "b"], "simple_average", ["id"])
    got = {r.id: r.y_pred for r in out.collect()}
    assert got[1] == pytest.approx((2.0 + 6.0) / 2)  # median of b over the batch (-9, 6, 8) is 6
    assert got[4] == 0.0  # clipped


def test_collapse_sum_null_when_all_null(spark):
    rows = [("s", "A", "X", 1, False, None, None, 2), ("s", "A", "X", 1, False, None, None, 4),
            ("s", "A", "X", 2, False, 1.0, 4.0, 2), ("s", "A", "X", 2, False, 2.0, None, 4)]
    df = spark.createDataFrame(rows, "data_source string, disease string, county string, yearweek int, is_future boolean, "
                                     "count double, source_total_count double, cnt int")
    df = df.withColumn("disease_rate", F.lit(None).cast("double"))
    got = {r.yearweek: r for r in collapse_panel(df).collect()}
    assert got[1]["count"] is None and got[1].cnt == 3.0
    assert got[2]["count"] == 3.0 and got[2].disease_rate == pytest.approx(0.75)


def test_labels_and_rounding(spark):
    df = spark.createDataFrame([("default", "base", "ridge"), ("nhi_ev_branch", None, "x"), ("nan", "ensemble", None)],
                               "model_task string, model_layer string, model_name string")
    assert [r[0] for r in df.select(model_method(df)).collect()] == ["base/ridge", "nhi_ev_branch/x", "ensemble/unknown"]
    v = spark.createDataFrame([(2.5,), (3.5,), (-1.2,), (None,)], "forecast_count double")
    assert [r[0] for r in v.select(rounded_count()).collect()] == [2, 4, 0, None]


def test_exact_medians_as_numpy(spark):
    import numpy as np

    from panelcast.functions.medians import exact_medians

    rng = np.random.default_rng(3)
    rows = [(float(rng.integers(0, 40)), float(rng.normal()), None if i % 3 else float(i), None, float("nan") if i % 2 else 1.5)
            for i in range(501)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(5)
    got = exact_medians(df, ["a", "b", "c", "d", "e"])
    for k, c in enumerate("abc"):
        assert got[c] == float(np.median([r[k] for r in rows if r[k] is not None]))
    assert got["d"] is None and got["e"] == 1.5
    assert exact_medians(df.limit(0), ["a"]) == {"a": None}

"""End-to-end invariants of the forecast run on the smallest driver tables."""

from dataclasses import replace

from pyspark.sql import functions as F

from panelcast import config as C
from panelcast.operators.evaluate import select_final_model
from panelcast.plans import catalog as K
from panelcast.plans.forecast import run_forecast
from panelcast.sources import testviews as TV

SF = "/root/testdata/sf0.001"


def test_forecast_run_invariants(spark):
    out = run_forecast(K.task_inputs(spark, SF), TV.SRC_A, "nhi_non_ev_county", TV.TEST_BASE_DATE,
                       K.run_options(meta_model="simple_average", compare=("ridge", "weighted_average")))
    compared = out["combiner_comparison"]
    assert {r.model_name for r in compared.select("model_name").distinct().collect()} == {"stacking_ridge", "ensemble_weighted_average"}
    weights = {r.base_model: r.weight for r in out["combiner_weights"].collect()}
    assert abs(sum(weights.values()) - 1) < 1e-9
    assert {"run_mode", "feature_set", "feature_select", "top_k", "covid_policy", "enable_grid_search"} <= set(out["metric"].columns)
    fc = out["forecast"]
    rows = fc.collect()
    assert rows, "no forecast rows"
    series = {(r.data_source, r.disease, r.county) for r in rows}
    assert len(rows) == len(series) * C.DEFAULT_FORECAST_PERIOD
    assert {r.lead_week for r in rows} == set(range(1, C.DEFAULT_FORECAST_PERIOD + 1))
    assert all(r.forecast_count_rounded >= 0 for r in rows)
    offshore = set(TV.TEST_OFFSHORE)
    assert not any(r.county in offshore for r in rows)  # collapsed into one label
    metric = out["metric"]
    choice = select_final_model(metric, "simple_average", metric.select("meta_eval_type").first()[0]).first()
    assert {r.model_name for r in rows} == {choice.final_model_name}
    levels = {r.metric_level for r in metric.select("metric_level").distinct().collect()}
    assert levels == {"overall", "by_disease", "by_county", "by_disease_county"}
    base = out["base_prediction"]
    assert base.count() == len(rows) * base.select("base_model").distinct().count()
    assert out["feature_report"].where(F.col("selected")).count() > 0


def test_holdout_run_invariants(spark, monkeypatch):
    from panelcast.operators import models
    from panelcast.plans.forecast import run_holdout

    # the branch task always takes the Poisson models: few trees here, all of the run's steps
    monkeypatch.setattr(models, "POISSON_PRESETS", {k: replace(p, iterations=6) for k, p in models.POISSON_PRESETS.items()})

    out = run_holdout(K.task_inputs(spark, SF), TV.SRC_A, "nhi_ev_branch", TV.TEST_BASE_DATE, K.train_cut(spark, SF), 8,
                      K.run_options(meta_model="weighted_average"))
    pred = out["predictions"].collect()
    assert pred
    assert {r.lead_week for r in pred} <= set(range(1, 9))
    assert all(r.actual_count is not None and r.forecast_count >= 0 for r in pred)
    assert "rejected_series" in out and out["metric"].select("meta_eval_type").distinct().collect()[0][0] == "holdout_backtest"
    hw = out["holdout_weeks"]
    assert len(hw) == 8 and {r.yearweek for r in pred} <= set(hw)
    levels = {r.metric_level for r in out["metric"].select("metric_level").distinct().collect()}
    assert "by_lead_week" in levels and "overall" in levels
    names = {r.model_name for r in out["metric"].where("metric_level = 'overall'").collect()}
    assert "ensemble_weighted_average" in names and "seasonal_naive" in names

"""The end-to-end queries fit the run mode's own pool at preset iterations (no model is fitted here)."""

import inspect

from panelcast import config as C
from panelcast.operators import models as M
from panelcast.operators.selection import RANKING, importance_topk
from panelcast.plans import catalog as K
from panelcast.plans import forecast as P

SF = "/root/testdata/sf0.001"


def pools(spark, monkeypatch, query, run, output):
    """Per task of a query its options and the models that they leave."""
    seen = {}

    def spy(inputs, data_source, model_task, *args):
        opts = args[-1]
        cfg = C.resolve_config(opts.run_mode, opts.recent_weeks, opts.feature_set, opts.feature_select, opts.top_k)
        seen[model_task] = (cfg, {s.name for s in M.resolve_allowed_registry(model_task, opts.models or cfg.models)})
        return {output: spark.range(1)}

    monkeypatch.setattr(P, run, spy)
    monkeypatch.setattr(K, "_MEMO", {})
    K.QUERIES[query](spark, SF).collect()
    return seen


def test_forecast_query_fits_the_pool_of_its_run_mode(spark, monkeypatch):
    seen = pools(spark, monkeypatch, "pan_07_forecast_run", "run_forecast", "forecast")
    cfg, pool = seen[K.RUN_TASK]
    assert pool == set(C.RUN_MODES["smoke"].models) and "lightgbm" in pool
    assert cfg.recent_weeks is None


def test_holdout_query_fits_the_branch_task_too(spark, monkeypatch):
    seen = pools(spark, monkeypatch, "cv_08_holdout_run", "run_holdout", "metric")
    assert "lightgbm" in seen[K.RUN_TASK][1]
    cfg, pool = seen["nhi_ev_branch"]
    assert pool == {"seasonal_naive", "lightgbm", "xgboost_poisson", "lightgbm_poisson", "catboost_poisson"}
    assert cfg.features.select == "lgbm_topk" and cfg.recent_weeks is None


def test_preset_iterations():
    assert {k: v.iterations for k, v in M.GBT_PRESETS.items()} == {"xgboost": 350, "lightgbm": 450, "catboost": 350}
    assert {k: v.iterations for k, v in M.POISSON_PRESETS.items()} == {"xgboost_poisson": 500, "lightgbm_poisson": 700, "catboost_poisson": 500}
    assert RANKING.iterations == 250 and inspect.signature(importance_topk).parameters["max_iter"].default is None

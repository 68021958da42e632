"""Error paths and small composites (SET-2, SET-7, CV-7, SNK-3, SRC-11, FIL-6, PAN-5)."""

import pytest
from pyspark.sql import functions as F

from panelcast import config as C
from panelcast.operators.features import lag_rolling_features
from panelcast.operators.panel import apply_covid_policy, collapse_panel, prepare_task
from panelcast.operators.reports import sorted_for_output
from panelcast.sources.scans import normalize_target, pick_col
from panelcast.sources.sinks import execute


def _feature(spark):
    rows = [("s", "EV", "金門縣", 202001, False, 1.0, 10.0, 0.1, 20.5),
            ("s", "EV", "澎湖縣", 202001, False, 2.0, None, None, 21.5),
            ("s", "ILI", "台北市", 202001, False, 3.0, 30.0, 0.1, 19.0),
            ("s", "ILI", "台北市", 202102, True, None, None, None, 18.0)]
    return spark.createDataFrame(rows, "data_source string, disease string, county string, yearweek int, is_future boolean, "
                                       "count double, source_total_count double, disease_rate double, airtemperature_avg double")


def test_prepare_task_routes(spark):
    f = _feature(spark)
    nat, removed = prepare_task(f, "rods", "rods_ev_national")
    assert removed == ["airtemperature_avg"]
    r = nat.collect()
    assert len(r) == 1 and r[0].county == C.NATIONAL_LABEL and r[0]["count"] == 3.0 and r[0].source_total_count == 10.0
    off, _ = prepare_task(f, "other", "default")
    got = {(x.county, x.yearweek): x for x in off.collect()}
    assert got[(C.OFFSHORE_LABEL, 202001)]["count"] == 3.0
    with pytest.raises(RuntimeError):
        prepare_task(f.where(F.col("disease") != "EV"), "rods", "rods_ev_national")


def test_guards(spark):
    f = _feature(spark)
    with pytest.raises(ValueError):
        collapse_panel(f.drop("is_future"))
    with pytest.raises(ValueError):
        apply_covid_policy(f, "drop")
    assert apply_covid_policy(f, "exclude", (2020, 2020)).count() == 1  # only the future row survives
    with pytest.raises(ValueError):
        lag_rolling_features(f, "huge")
    with pytest.raises(KeyError):
        pick_col(f, ["nope"])
    with pytest.raises(KeyError):
        normalize_target(spark.createDataFrame([(1, "x")], "yearweek int, county string"))
    with pytest.raises(ValueError):
        C.SourceRegistry(sources={"a": "t"}).table_for("b")
    with pytest.raises(ValueError):
        C.resolve_config("nope")
    assert C.resolve_config("fast", recent_weeks=10).recent_weeks == 10


def test_union_output_and_statement(spark):
    a = spark.createDataFrame([("s", 1)], "data_source string, x int")
    b = spark.createDataFrame([("t", 2.0)], "data_source string, y double")
    u = a.unionByName(b, allowMissingColumns=True)
    assert sorted(u.columns) == ["data_source", "x", "y"] and u.count() == 2
    execute(spark, "CREATE OR REPLACE TEMP VIEW pc_tmp AS SELECT :v AS v", {"v": 3})
    assert spark.table("pc_tmp").first().v == 3
    out = sorted_for_output(spark.createDataFrame([("b", 1), ("a", 2)], "feature string, x int")
                            .withColumn("data_source", F.lit("s")), "features")
    assert [r.feature for r in out.collect()] == ["a", "b"]


def test_compare_meta_models(spark):
    import numpy as np

    from panelcast.plans.forecast import compare_meta_models

    rng = np.random.default_rng(1)
    rows = []
    for i in range(60):
        y = float(rng.integers(0, 20))
        rows.append(("s", "d", "c", 200001 + i, y, y + float(rng.normal()), y * 0.8))
    m = spark.createDataFrame(rows, "data_source string, disease string, county string, yearweek int, y_true double, "
                                    "a double, b double")
    out = compare_meta_models(m, ["a", "b"], ["simple_average", "ridge"], 2,
                              {"data_source": "s", "model_task": "default", "model_scope": "county", "prediction_type": "oof"})
    names = {r.model_name for r in out.where("metric_level = 'overall'").collect()}
    assert names == {"ensemble_simple_average", "stacking_ridge"}


def test_publish_reports(spark):
    import tempfile

    from panelcast.plans.forecast import RunOptions, publish_reports, summary_settings

    rows = [("s", "default", "county", "base", "m1", "overall", "ALL", "ALL", None, 10, 0.5),
            ("s", "default", "county", "ensemble", "ensemble_simple_average", "overall", "ALL", "ALL", None, 10, 0.4),
            ("s", "default", "county", "base", "m1", "by_lead_week", "ALL", "ALL", 1, 5, 0.6)]
    metric = spark.createDataFrame(rows, "data_source string, model_task string, model_scope string, model_layer string, "
                                         "model_name string, metric_level string, disease string, county string, "
                                         "lead_week int, n_obs long, WAPE double")
    d = tempfile.mkdtemp(prefix="pc-rep-")
    settings = summary_settings("holdout", ["s", "t"], RunOptions("fast", meta_model="ridge", compare=("lasso", "huber")), 202210, 8, 30)
    assert settings["forecast_period"] is None and settings["feature_set"] == "medium" and settings["top_k"] == 60
    paths = publish_reports({"metric": metric}, d, settings, fmt="csv")
    assert set(paths) == {"metric", "leaderboard", "breakdown", "meta_model_comparison", "lead_week_summary", "run_summary"}
    summary = spark.read.option("header", True).csv(paths["run_summary"]).first()
    assert summary.best_model_by_wape == "ensemble/ensemble_simple_average"
    assert (summary.sources, summary.end_week, summary.recent_weeks, summary.compare_meta_models) == ("s,t", "202210", "260", "lasso,huber")
    # SRT-1: the written metrics are in the output order
    written = [(r.model_name, r.metric_level) for r in spark.read.option("header", True).csv(paths["metric"]).collect()]
    assert written == [("ensemble_simple_average", "overall"), ("m1", "by_lead_week"), ("m1", "overall")]
    comp = spark.read.option("header", True).csv(paths["meta_model_comparison"]).first()
    assert comp.best_base_model == "m1" and comp.stacking_wins == "true"


def test_registry_source_load(spark):
    import tempfile

    from panelcast.sources.scans import load_source

    d = tempfile.mkdtemp(prefix="pc-src-")
    spark.createDataFrame([(202001, "X", "EV", 3), (202105, "X", "EV", 4)],
                          "yearweek int, county string, disease string, count int").write.parquet(f"{d}/src.parquet")
    reg = C.SourceRegistry(sources={"nhi_er": f"{d}/src.parquet"})
    got = load_source(spark, reg, "nhi_er", start_week=202101).collect()
    assert [(r.yearweek, r.data_source, r["count"]) for r in got] == [(202105, "nhi_er", 4.0)]
    with pytest.raises(ValueError):
        load_source(spark, reg, "rods")
    with pytest.raises(RuntimeError):
        load_source(spark, reg, "nhi_er", start_week=203001)


def test_defaults_from_the_environment():
    assert C.RunDefaults.from_env({}) == C.RunDefaults(8, None)
    assert C.RunDefaults.from_env({"PANELCAST_FORECAST_PERIOD": "4", "PANELCAST_TRAIN_START_YEARWEEK": "202001"}) == C.RunDefaults(4, 202001)
    reg = C.SourceRegistry.from_env({"PANELCAST_SOURCE_A": "t2", "PANELCAST_WEATHER": "w2"}, sources={"a": "t", "b": "u"}, dim_holiday="h")
    assert (reg.table_for("a"), reg.table_for("b"), reg.weather, reg.dim_holiday) == ("t2", "u", "w2", "h")


def test_short_history_warns(spark):
    from panelcast.plans.forecast import holdout_weeks

    def weeks(n):
        return spark.createDataFrame([(202000 + i,) for i in range(1, n + 1)], "yearweek int")

    with pytest.warns(UserWarning, match="less than a season"):
        assert holdout_weeks(weeks(20), 202099, 8) == list(range(202013, 202021))
    with pytest.raises(RuntimeError):
        holdout_weeks(weeks(8), 202099, 8)


def test_output_order(spark):
    rows = [("s", "t", "m2", "overall", "A", "x", 1), ("s", "t", "m1", "overall", "B", "x", 2), ("s", "t", "m1", "by_county", "B", "y", 1),
            ("r", "t", "m9", "overall", "A", "x", 3), ("s", "t", "m1", "overall", "B", "x", 1)]
    df = spark.createDataFrame(rows, "data_source string, model_task string, model_name string, metric_level string, "
                                     "disease string, county string, lead_week int").repartition(4)
    assert [tuple(r) for r in sorted_for_output(df, "metrics").collect()] == sorted(rows)

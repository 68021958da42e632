"""Edge rows from FIXTURES.md that are not covered elsewhere."""

import pytest
from pyspark.sql import functions as F

from panelcast.operators.combine import drop_empty_models, melt, rule_weights
from panelcast.operators.panel import complete_horizon
from panelcast.operators.reports import breakdown, leaderboard
from panelcast.sources.scans import load_source_total, normalize_target


def test_text_totals_and_counts_become_null(spark):
    tot = spark.createDataFrame([("s", "202001", "X", "12"), ("s", "202001", "X", "abc"), ("s", "202002", "X", None),
                                 ("s", "202003", "X", "0")], "data_source string, yearweek string, county string, total_count string")
    got = {r.yearweek: r.source_total_count for r in load_source_total(tot, "s").collect()}
    assert got == {202001: 12.0, 202002: None, 202003: 0.0}
    tgt = spark.createDataFrame([(202001, "X", "n/a"), (202002, "X", "3")], "yearweek int, city string, cnt string")
    rows = normalize_target(tgt).orderBy("yearweek").collect()
    assert [r["count"] for r in rows] == [None, 3.0] and rows[0].disease == "ALL" and rows[0].county == "X"


def test_all_null_model_column_is_dropped(spark):
    m = spark.createDataFrame([(1.0, 2.0, None), (2.0, None, None)], "y_true double, a double, b double")
    assert drop_empty_models(m, ["a", "b"]) == ["a"]


def test_topk_ties_follow_column_order(spark):
    m = spark.createDataFrame([(1.0, 2.0, 2.0, 2.0)], "y_true double, a double, b double, c double")
    w = {r.model_name: r.weight for r in rule_weights(melt(m, ["y_true"], ["c", "a", "b"]), "topk_average", 2).collect()}
    assert w == {"c": 0.5, "a": 0.5, "b": 0.0}


def test_null_wape_sorts_last(spark):
    rows = [("s", "default", "base", "m1", "overall", None), ("s", "default", "base", "m2", "overall", 0.5),
            ("s", "default", "base", "m3", "by_disease", None), ("s", "default", "base", "m4", "by_disease", 0.1),
            ("s", "default", "base", "m5", "by_disease", 0.9)]
    df = spark.createDataFrame(rows, "data_source string, model_task string, model_layer string, model_name string, "
                                     "metric_level string, WAPE double").withColumn("disease", F.lit("A")).withColumn("county", F.lit("ALL"))
    assert [r.model_method for r in leaderboard(df).collect()] == ["base/m2", "base/m1"]
    assert [r.model_method for r in breakdown(df, 2).collect()] == ["base/m5", "base/m4"]


def test_short_future_series_is_rejected(spark):
    rows = [("s", "A", "X", 202101 + i) for i in range(3)] + [("s", "A", "Y", 202101)]
    fut = spark.createDataFrame(rows, "data_source string, disease string, county string, yearweek int")
    kept, rejected = complete_horizon(fut, 3)
    assert {r.county for r in kept.collect()} == {"X"}
    assert [(r.county, r.rows) for r in rejected.collect()] == [("Y", 1)]

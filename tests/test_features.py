"""Window features against plain-Python loops on a small panel with gaps and nulls."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators.features import future_features, lag_rolling_features, seasonal_naive
from panelcast.operators.panel import complete_horizon

KEY = ["data_source", "disease", "county"]


def _panel(spark, n_series=3, seed=7):
    rnd = random.Random(seed)
    rows = []
    for s in range(n_series):
        weeks = [202001 + i for i in range(40) if rnd.random() > 0.15]  # gaps
        n = len(weeks) if s else 1  # one series with a single row
        for w in weeks[:n]:
            cnt = float(rnd.randint(0, 9))
            tot = None if rnd.random() < 0.2 else float(rnd.randint(0, 30))
            rate = cnt / tot if tot else None
            rows.append(("src", f"d{s % 2}", f"c{s}", w, cnt, tot, rate))
    return spark.createDataFrame(rows, "data_source string, disease string, county string, yearweek int, count double, "
                                       "source_total_count double, disease_rate double")


def _std(vals):
    return float(np.std(vals, ddof=1)) if len(vals) > 1 else None


def test_training_features_match_loop(spark):
    df = _panel(spark)
    got = {(r.county, r.yearweek): r for r in lag_rolling_features(df, "medium").collect()}
    series = {}
    for r in df.orderBy("yearweek").collect():
        series.setdefault(r.county, []).append(r)
    for c, rows in series.items():
        for i, r in enumerate(rows):
            g = got[(c, r.yearweek)]
            prev = [x["count"] for x in rows[:i]]
            assert g.lag_1 == (prev[-1] if len(prev) >= 1 else None)
            assert g.lag_52 is None
            win = [x for x in prev[-4:] if x is not None]
            assert (g.roll4_mean is None) == (not win)
            if win:
                assert g.roll4_mean == pytest.approx(sum(win) / len(win))
            sd = _std(win)
            assert (g.roll4_std is None) == (sd is None)
            if sd is not None:
                assert g.roll4_std == pytest.approx(sd)
            cmp = prev[-5] if len(prev) >= 5 else None
            if g.lag_1 is not None and cmp is not None:
                assert g.diff_4 == pytest.approx(g.lag_1 - cmp)
                assert (g.growth_4 is None) == (cmp == 0)
            totals = [x.source_total_count for x in rows[:i]]
            assert g.source_total_count_lag_2 == (totals[-2] if len(totals) >= 2 else None)


def _future_loop(hist_vals, horizon, lags, windows, diffs):
    h = list(hist_vals)
    out = []
    for _ in range(horizon):
        item = {}
        for k in lags:
            item[f"lag_{k}"] = h[-k] if len(h) >= k else None
        for w in windows:
            v = h[-w:]
            item[f"roll{w}_mean"] = sum(v) / len(v) if v else None
            item[f"roll{w}_std"] = float(np.std(v, ddof=1)) if len(v) > 1 else 0.0
        base = item["lag_1"]
        for k in diffs:
            cmp = h[-(k + 1)] if len(h) >= k + 1 else None
            item[f"diff_{k}"] = base - cmp if base is not None and cmp is not None else None
            item[f"growth_{k}"] = (base - cmp) / cmp if base is not None and cmp not in (None, 0) else None
        out.append(item)
        h.append(h[-1] if h else 0.0)
    return out


def test_future_features_match_loop(spark):
    hist = _panel(spark)
    fut_rows = []
    for c, d in (("c0", "d0"), ("c1", "d1"), ("c2", "d0")):
        for i in range(4):
            fut_rows.append(("src", d, c, 202101 + i, None, 5.0, None))
    fut = spark.createDataFrame(fut_rows, hist.schema)
    kept, rejected = complete_horizon(fut, 3)
    assert rejected.count() == 0
    got = future_features(hist, kept, "medium", 3).collect()
    series = {}
    for r in hist.orderBy("yearweek").collect():
        series.setdefault(r.county, []).append(r)
    for r in got:
        counts = [x["count"] for x in series[r.county] if x["count"] is not None]
        exp = _future_loop(counts, 3, [1, 2, 3, 4, 8, 12, 26, 52], [4, 8, 12, 26], [1, 4])[r.lead_week - 1]
        for k, v in exp.items():
            assert (getattr(r, k) is None) == (v is None), (k, r.county, r.lead_week)
            if v is not None:
                assert getattr(r, k) == pytest.approx(v), (k, r.county, r.lead_week)
        totals = [x.source_total_count for x in series[r.county] if x.source_total_count is not None]
        if totals:
            texp = _future_loop(totals, 3, [1, 2], [4], [])[r.lead_week - 1]
            assert r.source_total_count_lag_2 == texp["lag_2"]
            assert r.source_total_count_roll4_mean == pytest.approx(texp["roll4_mean"])
        else:
            assert r.source_total_count_lag_1 is None


def _naive_loop(y, steps, season=52):
    fb = float(np.mean(y[-season:])) if y else 0.0
    h, out = list(y), []
    for _ in range(steps):
        p = h[-season] if len(h) >= season else fb
        out.append(p)
        h.append(p)
    return out


@pytest.mark.parametrize("n", [0, 1, 30, 51, 52, 53, 104, 130])
def test_seasonal_naive_matches_loop(spark, n):
    rnd = random.Random(n)
    y = [float(rnd.randint(0, 20)) for _ in range(n)]
    steps = 120
    train = spark.createDataFrame([("g", 1000 + i, v) for i, v in enumerate(y)] or [("x", 0, 1.0)],
                                  "g string, yearweek int, count double")
    targets = spark.createDataFrame([("g", h) for h in range(1, steps + 1)], "g string, h int")
    got = sorted((r.h, r.seasonal_naive) for r in seasonal_naive(train, targets, ["g"]).collect())
    if n == 0:
        assert got == []  # a series without training rows gets no prediction
        return
    exp = _naive_loop(y, steps)
    assert [v for _, v in got] == pytest.approx(exp)


def test_rolling_statistics_keep_their_digits(spark):
    """Large offsets and constant series: frame aggregates lose nothing to cancellation."""
    import numpy as np

    values = [1e8 + (i * 37 % 11) for i in range(40)]
    rows = [("s", "d", "x", 202001 + i, v, v, v) for i, v in enumerate(values)]
    rows += [("s", "d", "y", 202001 + i, 0.1, 0.1, 0.1) for i in range(40)]
    df = spark.createDataFrame(rows, "data_source string, disease string, county string, yearweek int, count double, "
                                     "source_total_count double, disease_rate double")
    out = lag_rolling_features(df, "base").orderBy("county", "yearweek").collect()
    for i in range(5, 40):
        assert abs(out[i]["roll4_std"] - np.std(values[i - 4 : i], ddof=1)) < 1e-6
        assert abs(out[i]["roll4_mean"] - np.mean(values[i - 4 : i])) < 1e-6
    assert {r["roll4_std"] for r in out[42:]} == {0.0}

"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Timing in ``queries`` is the second of two runs. ``panel_build`` times the heavy
part from scratch (fact scans, joins and weekly aggregation into the
checkpointed panels); the other queries then run on the materialised panels, as
a pipeline run would. With BENCH_COLD=1, ``cold`` has each query from nothing but
the tables (every stored panel is forgotten first) and ``runs`` the two
end-to-end runs, cold.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "pan_01_feature_table",
    "win_01_07_lag_rolling_full",
    "win_10_future_features",
    "win_12_seasonal_naive_forecast",
    "cv_05_seasonal_naive_oof_metrics",
    "agg_05_metric_table",
    "rep_05_leaderboard",
    "pan_03_ev_branch_collapse",
    "agg_06_holdout_metric_levels",
    "agg_09_feature_profile",
]
RUNS = ["pan_07_forecast_run", "cv_08_holdout_run"]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from panelcast.plans import catalog as K
    from panelcast.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    extra = [a for a in sys.argv[1:] if not a.startswith("-")]
    names = extra or HEADLINE
    times: dict[str, float] = {}

    def build_panels():
        K._MEMO.clear()
        for fn in (K.target_a, K.target_b, K.source_total_a, K.weather, K.calendar):
            fn(spark, sf_dir)
        K.forecast_weeks(spark, sf_dir)
        K.train_cut(spark, sf_dir)

    for i in range(2):
        t0 = time.time()
        build_panels()
        times["panel_build"] = round(time.time() - t0, 3)
    qs = K.QUERIES
    for name in names:
        for i in range(2):
            t0 = time.time()
            _run(qs[name](spark, sf_dir))
            times[name] = round(time.time() - t0, 3)
    cold, runs = {}, {}
    for name in [*names, *([] if extra else RUNS)] if os.environ.get("BENCH_COLD") else []:
        K._MEMO.clear()
        t0 = time.time()
        _run(qs[name](spark, sf_dir))
        (runs if name in RUNS else cold)[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "cold": cold, "runs": runs, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()

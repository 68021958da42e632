"""DuckDB SQL fragments for the oracle twins of the registered queries.

These strings only feed the driver's independent check; the engine itself
never parses or plans SQL.
"""

from __future__ import annotations

from panelcast import config as C

KEY = "data_source, disease, county"
METRICS = ["MAE", "RMSE", "MAPE", "sMAPE", "WAPE", "Bias", "Pearson", "HitRate",
           "y_true_sum", "y_pred_sum", "y_true_mean", "y_pred_mean"]


def r6(expr: str) -> str:
    return f"(round({expr}, 6) + 0.0)"


def hit_cte(src: str, group_cols: list[str]) -> str:
    part = ", ".join([*group_cols, "data_source", "disease", "county"])
    return f"""
        SELECT *, CASE WHEN _td IS NOT NULL AND _pd IS NOT NULL THEN CAST(sign(_td) = sign(_pd) AS DOUBLE) END AS _hit
        FROM (SELECT *, y_true - lag(y_true) OVER (PARTITION BY {part} ORDER BY yearweek) AS _td,
                        y_pred - lag(y_pred) OVER (PARTITION BY {part} ORDER BY yearweek) AS _pd
              FROM {src})"""


def metric_select(group_cols: list[str], src: str, by_lead_week: bool = False, rounded: bool = True) -> str:
    """GROUPING SETS metrics over ``src`` (must carry y_true, y_pred, _hit, disease, county[, lead_week])."""
    g = ", ".join(group_cols)
    sets = [f"({g})", f"({g}, disease)", f"({g}, county)", f"({g}, disease, county)"]
    if by_lead_week:
        sets.append(f"({g}, lead_week)")
    rnd = r6 if rounded else (lambda x: x)
    lvl = "CASE "
    if by_lead_week:
        lvl += "WHEN grouping(lead_week) = 0 THEN 'by_lead_week' "
    lvl += ("WHEN grouping(disease) = 1 AND grouping(county) = 1 THEN 'overall' "
            "WHEN grouping(county) = 1 THEN 'by_disease' WHEN grouping(disease) = 1 THEN 'by_county' "
            "ELSE 'by_disease_county' END")
    m = {
        "MAE": "avg(abs(y_pred - y_true))",
        "RMSE": "sqrt(avg((y_pred - y_true) * (y_pred - y_true)))",
        "MAPE": "avg(CASE WHEN y_true <> 0 THEN abs(y_pred - y_true) / abs(y_true) END)",
        "sMAPE": "avg(CASE WHEN abs(y_true) + abs(y_pred) <> 0 THEN 2 * abs(y_pred - y_true) / (abs(y_true) + abs(y_pred)) END)",
        "WAPE": "CASE WHEN sum(y_true) <> 0 THEN sum(abs(y_pred - y_true)) / abs(sum(y_true)) END",
        "Bias": "CASE WHEN sum(y_true) <> 0 THEN (sum(y_pred) - sum(y_true)) / sum(y_true) END",
        "Pearson": ("CASE WHEN count(*) >= 2 AND stddev_pop(y_true) > 0 AND stddev_pop(y_pred) > 0 "
                    "THEN covar_pop(y_true, y_pred) / (stddev_pop(y_true) * stddev_pop(y_pred)) END"),
        "HitRate": "avg(_hit)",
        "y_true_sum": "CAST(sum(y_true) AS DOUBLE)",
        "y_pred_sum": "CAST(sum(y_pred) AS DOUBLE)",
        "y_true_mean": "avg(y_true)",
        "y_pred_mean": "avg(y_pred)",
    }
    cols = [*group_cols, f"{lvl} AS metric_level", "coalesce(CAST(disease AS VARCHAR), 'ALL') AS disease",
            "coalesce(CAST(county AS VARCHAR), 'ALL') AS county"]
    if by_lead_week:
        cols.append("lead_week")
    cols.append("count(*) AS n_obs")
    cols += [f"{rnd(m[k])} AS {k}" for k in METRICS]
    return f"""SELECT {', '.join(cols)}
        FROM {src}
        WHERE y_true IS NOT NULL AND y_pred IS NOT NULL AND isfinite(y_true) AND isfinite(y_pred)
        GROUP BY GROUPING SETS ({', '.join(sets)})"""


def feature_exprs(feature_set: str, measures=("count", "source_total_count", "disease_rate"),
                  part: str = KEY, order: str = "yearweek") -> list[str]:
    """Window feature expressions (WIN-1..7) in DuckDB."""
    cfg = C.FEATURE_SETS[feature_set]
    w = f"PARTITION BY {part} ORDER BY {order}"
    out = []
    prefixes = {"count": "", "source_total_count": "source_total_count_", "disease_rate": "disease_rate_"}
    for m in measures:
        p = prefixes[m]
        for k in cfg["lags"]:
            out.append(f"lag({m}, {k}) OVER ({w}) AS {p}lag_{k}")
        for win in cfg["rolling_windows"]:
            fr = f"({w} ROWS BETWEEN {win} PRECEDING AND 1 PRECEDING)"
            out.append(f"avg({m}) OVER {fr} AS {p}roll{win}_mean")
            out.append(f"stddev_samp({m}) OVER {fr} AS {p}roll{win}_std")
        if m == "count":
            for k in cfg["diff_lags"]:
                out.append(f"lag(count, 1) OVER ({w}) - lag(count, {k + 1}) OVER ({w}) AS diff_{k}")
            for k in cfg["growth_lags"]:
                c = f"lag(count, {k + 1}) OVER ({w})"
                out.append(f"CASE WHEN {c} <> 0 THEN (lag(count, 1) OVER ({w}) - {c}) / {c} END AS growth_{k}")
    return out


def feature_names(feature_set: str, measures=("count", "source_total_count", "disease_rate")) -> list[str]:
    return [e.rsplit(" AS ", 1)[1] for e in feature_exprs(feature_set, measures)]


def seasonal_naive_sql(train_src: str, target_src: str, group: str, out_col: str = "seasonal_naive",
                       season: int = 52) -> dict:
    """CTEs for WIN-12: train_src has group cols + yearweek + count; target_src has group cols + h.

    Returns the CTE dict; the last one (``sn_pred``) has target columns + ``out_col``.
    """
    on = " AND ".join(f"p.{c.strip()} = x.{c.strip()}" for c in group.split(","))
    return {
        "sn_pos": f"""SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY yearweek) AS _pos,
                             count(*) OVER (PARTITION BY {group}) AS _n
                      FROM {train_src} WHERE count IS NOT NULL""",
        "sn_stats": f"""SELECT {group}, max(_n) AS _n,
                               coalesce(avg(CASE WHEN _pos > _n - {season} THEN count END), 0.0) AS _fb
                        FROM sn_pos GROUP BY {group}""",
        "sn_idx": f"""SELECT *, CASE WHEN _idx0 >= _n THEN _idx0 - {season} * CAST(ceil((_idx0 - _n + 1) / {season}.0) AS BIGINT)
                                     ELSE _idx0 END AS _idx
                      FROM (SELECT t.*, s._n, s._fb, s._n + t.h - 1 - {season} AS _idx0
                            FROM {target_src} t JOIN sn_stats s USING ({group}))""",
        "sn_pred": f"""SELECT x.* EXCLUDE (_n, _fb, _idx0, _idx),
                              CASE WHEN x._idx < 0 THEN x._fb ELSE p.count END AS {out_col}
                       FROM sn_idx x LEFT JOIN sn_pos p ON {on} AND p._pos = x._idx + 1""",
    }


def ctes(d: dict) -> str:
    return ",\n".join(f"{k} AS ({v})" for k, v in d.items())


def future_feature_ctes(hist_src: str, measure: str, prefix: str, feature_set: str, horizon: int, name: str) -> dict:
    """WIN-10 in DuckDB: compacted history + carried rows, trailing frames, steps 1..horizon (CTE ``name``)."""
    cfg = C.FEATURE_SETS[feature_set]
    seq, ext = f"{name}_seq", f"{name}_ext"
    w = f"PARTITION BY {KEY} ORDER BY _pos"
    cols = ["_pos - _n + 1 AS lead_week"]
    for k in cfg["lags"]:
        cols.append(f"_v AS {prefix}lag_{k}" if k == 1 else f"lag(_v, {k - 1}) OVER ({w}) AS {prefix}lag_{k}")
    for win in cfg["rolling_windows"]:
        fr = f"({w} ROWS BETWEEN {win - 1} PRECEDING AND CURRENT ROW)"
        cols.append(f"avg(_v) OVER {fr} AS {prefix}roll{win}_mean")
        cols.append(f"coalesce(stddev_samp(_v) OVER {fr}, 0.0) AS {prefix}roll{win}_std")
    if measure == "count":
        for k in cfg["diff_lags"]:
            cols.append(f"_v - lag(_v, {k}) OVER ({w}) AS diff_{k}")
        for k in cfg["growth_lags"]:
            c = f"lag(_v, {k}) OVER ({w})"
            cols.append(f"CASE WHEN {c} <> 0 THEN (_v - {c}) / {c} END AS growth_{k}")
    return {
        seq: f"""SELECT {KEY}, CAST({measure} AS DOUBLE) AS _v,
                        row_number() OVER (PARTITION BY {KEY} ORDER BY yearweek) AS _pos,
                        count(*) OVER (PARTITION BY {KEY}) AS _n
                 FROM {hist_src} WHERE {measure} IS NOT NULL""",
        ext: f"""SELECT {KEY}, _v, _pos, _n FROM {seq}
                 UNION ALL
                 SELECT {KEY}, _v, _n + r.s AS _pos, _n FROM {seq}, range(1, {horizon}) r(s) WHERE _pos = _n""",
        name: f"""SELECT * EXCLUDE (_pos, _n) FROM (SELECT {KEY}, _pos, _n, {', '.join(cols)} FROM {ext}) WHERE _pos >= _n""",
    }


def rolling_fold_ctes(src: str, n_splits: int, min_train: int, name: str) -> dict:
    """CV-1 in DuckDB: expanding folds over the distinct weeks of ``src`` -> CTE ``name``(fold, yearweek, role).

    Covers the fold-count shrink for short histories; the 80/20 fallback is not needed by the fixtures.
    """
    k, mt = n_splits, min_train
    shrink_k = "greatest(2, least(3, n // 26))"
    return {
        f"{name}_w": f"""SELECT yearweek, row_number() OVER (ORDER BY yearweek) AS wr, count(*) OVER () AS n
                         FROM (SELECT DISTINCT yearweek FROM {src})""",
        f"{name}_p": f"""SELECT n, CASE WHEN n < {mt + k} THEN {shrink_k} ELSE {k} END AS k,
                                CASE WHEN n < {mt + k} THEN greatest(52, n - 8 * {shrink_k}) ELSE {mt} END AS mt
                         FROM (SELECT max(n) AS n FROM {name}_w)""",
        f"{name}_f": f"""SELECT r.i AS fold, n - (k - r.i) * (n // (k + 1)) AS tr_end, n - (k - r.i - 1) * (n // (k + 1)) AS va_end
                         FROM {name}_p, range(0, 10) r(i) WHERE r.i < k AND n - (k - r.i) * (n // (k + 1)) >= mt""",
        name: f"""SELECT f.fold, w.yearweek, CASE WHEN w.wr <= f.tr_end THEN 'train' ELSE 'valid' END AS role
                  FROM {name}_f f JOIN {name}_w w ON w.wr <= f.va_end""",
    }


def rule_weight_ctes(long_fit: str, method: str, topk: int, name: str) -> dict:
    """COM-2..4 in DuckDB over ``long_fit``(fold, model_name, _model_pos, y_true, y_pred) -> ``name``(fold, model_name, weight)."""
    per = f"""SELECT fold, model_name, _model_pos,
                     CASE WHEN sum(abs(y_true)) = 0 THEN CAST('inf' AS DOUBLE)
                          ELSE sum(abs(y_pred - y_true)) / sum(abs(y_true)) END AS wape
              FROM {long_fit} GROUP BY fold, model_name, _model_pos"""
    if method == "simple_average":
        w = f"SELECT fold, model_name, 1.0 / count(*) OVER (PARTITION BY fold) AS weight FROM {name}_per"
    elif method == "weighted_average":
        w = f"""SELECT fold, model_name,
                       CASE WHEN sum(inv) OVER (PARTITION BY fold) > 0 THEN inv / sum(inv) OVER (PARTITION BY fold)
                            ELSE 1.0 / count(*) OVER (PARTITION BY fold) END AS weight
                FROM (SELECT *, CASE WHEN isinf(wape) THEN 0.0 ELSE 1.0 / greatest(wape, 1e-6) END AS inv FROM {name}_per)"""
    else:
        w = f"""SELECT fold, model_name,
                       CASE WHEN rk <= least({topk}, nm) THEN 1.0 / least({topk}, nm) ELSE 0.0 END AS weight
                FROM (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY wape, _model_pos) AS rk,
                             count(*) OVER (PARTITION BY fold) AS nm FROM {name}_per)"""
    return {f"{name}_per": per, name: w}

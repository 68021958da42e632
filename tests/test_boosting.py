import math
from dataclasses import replace
from statistics import median

import numpy as np
import pytest

from panelcast.functions.medians import grouped_medians
from panelcast.operators import boosting as B
from panelcast.operators import models as M


def block(x, names, y, lay, score=None):
    key = np.arange(len(y), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    score = np.full(len(y), y.mean()) if score is None else score
    return B.Block({"n": len(y), "codes": lay.codes(x, names).tobytes(), "y": y.astype(float).tobytes(), "key": key.tobytes(), "score": score.tobytes()}, lay)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    x = rng.integers(0, 12, (260, 3)).astype(float)
    names = [[f"g{i}" for i in rng.integers(0, 4, 260)]]
    y = rng.poisson(np.exp(0.1 * x[:, 0] + 0.6 * (x[:, 1] > 5) + 0.8 * np.array([v == "g2" for v in names[0]]))).astype(float)
    lay = B.Layout([np.arange(11) + 0.5] * 3, [["g0", "g1", "g2", "g3"]])
    return x, names, y, lay


def questions(x, names):
    """Every question a split may ask: for numbers above a bound, for names equal to a level, as masks of the right side."""
    out = [x[:, j] > e for j in range(x.shape[1]) for e in np.arange(11) + 0.5]
    return out + [np.array([v == level for v in names[0]]) for level in ("g0", "g1", "g2", "g3")]


def leaf_score(g, h, rows, l2):
    return g[rows].sum() ** 2 / (h[rows].sum() + l2) if rows.any() else 0.0


def best_question(masks, g, h, rows, p):
    best = (1e-12, None)
    for k, m in enumerate(masks):
        left, right = rows & ~m, rows & m
        if min(left.sum(), right.sum()) < max(1, p.min_rows) or min(h[left].sum(), h[right].sum()) < p.min_hessian:
            continue
        gain = leaf_score(g, h, left, p.l2) + leaf_score(g, h, right, p.l2) - leaf_score(g, h, rows, p.l2)
        if gain > best[0] + 1e-9:
            best = (gain, k)
    return best


def brute_tree(masks, g, h, p):
    """Best leaf first (or level by level: the same once every leaf may be split)."""
    leaves = [(np.ones(len(g), bool), 0)]
    out, splits = np.zeros(len(g)), 0
    while len(leaves) < p.most_leaves:
        found = [(best_question(masks, g, h, rows, p) if p.depth is None or d < p.depth else (0, None)) for rows, d in leaves]
        i = max(range(len(leaves)), key=lambda k: found[k][0])
        if found[i][1] is None:
            break
        rows, d = leaves.pop(i)
        m = masks[found[i][1]]
        leaves += [(rows & ~m, d + 1), (rows & m, d + 1)]
        splits += 1
    for rows, _ in leaves:
        out[rows] = -g[rows].sum() / (h[rows].sum() + p.l2)
    return out, splits


PLAIN = {"rows": 1.0, "columns": 1.0}


@pytest.mark.parametrize("preset", ["xgboost", "lightgbm", "xgboost_poisson", "lightgbm_poisson"])
def test_tree_equals_brute_force(data, preset):
    x, names, y, lay = data
    p = replace(M.boosting_params(preset), **PLAIN, max_value=None)
    score = np.full(len(y), math.log(y.mean()) if p.poisson else y.mean())
    tree = B.grow_tree(block(x, names, y, lay, score), lay, p, score, 1, 0)
    g, h = B.gradients(y, score, p)
    want, splits = brute_tree(questions(x, names), g, h, p)
    assert tree.predict(lay.codes(x, names)) == pytest.approx(want, abs=1e-9)
    assert tree.splits.sum() == splits


def test_first_order_terms_by_hand():
    p = B.Params(1, 0.1, poisson=True, hessian_shift=0.7)
    g, h = B.gradients(np.array([3.0, 0.0, -2.0]), np.log(np.array([2.0, 2.0, 2.0])), p)
    assert g == pytest.approx([-1.0, 2.0, 2.0]) and h == pytest.approx([2 * math.exp(0.7)] * 3)


@pytest.mark.parametrize("preset", ["catboost", "catboost_poisson"])
def test_symmetric_tree_equals_exhaustive_search(data, preset):
    x, names, y, lay = data
    p = replace(M.boosting_params(preset), depth=3)
    score = np.full(len(y), math.log(y.mean()) if p.poisson else y.mean())
    tree = B.grow_tree(block(x, names, y, lay, score), lay, p, score, 1, 0)
    g, h = B.gradients(y, score, p)
    leaves = [np.ones(len(y), bool)]
    for _ in range(3):
        # the same question for every leaf
        best = max(questions(x, names), key=lambda m: sum(leaf_score(g, h, r & ~m, p.l2) + leaf_score(g, h, r & m, p.l2) for r in leaves))
        leaves = [r for rows in leaves for r in (rows & ~best, rows & best)]
    want = np.zeros(len(y))
    for rows in leaves:
        want[rows] = -g[rows].sum() / (h[rows].sum() + p.l2)
    assert len(tree.values) == 8 and tree.predict(lay.codes(x, names)) == pytest.approx(want, abs=1e-9)


def test_unseen_levels_and_drawn_shares(data):
    x, names, y, lay = data
    tree = B.grow_tree(block(x, names, y, lay), lay, replace(M.boosting_params("xgboost"), **PLAIN), np.full(len(y), y.mean()), 1, 0)
    assert np.isfinite(tree.predict(lay.codes(x[:2], [["never", None]]))).all()
    key = np.random.default_rng(0).integers(0, 2**63, 50_000).astype(np.uint64)
    one, two = B.drawn_rows(key, 0.85, 9101, 3), B.drawn_rows(key, 0.85, 9101, 4)
    assert abs(one.mean() - 0.85) < 0.01 and 0.1 < (one != two).mean() < 0.4
    assert (B.drawn_rows(key[::7], 0.85, 9101, 3) == one[::7]).all()
    kept = lay.drawn(0.5, 9101, 1)
    assert len(set(lay.feature[kept])) == int(0.5 * 7) and (lay.drawn(0.5, 9101, 1) == kept).all()


def _panel(spark, n=420, seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a, b = rng.normal(size=2)
        level = "abc"[i % 3]
        y = max(0.0, 5 + 2 * a - b * (level == "a") + rng.normal() * 0.3)
        rows.append((int(200001 + i // 6), f"k{i % 6}", None if i % 17 == 0 else float(a), float(b), None if i % 23 == 0 else level, float(y)))
    return spark.createDataFrame(rows, "yearweek int, county string, a double, b double, grp string, count double").checkpoint()


def test_several_blocks_give_the_same_trees(spark, monkeypatch):
    df = _panel(spark)
    settings = [M.boosting_params(p, max_iter=3) for p in ("xgboost", "lightgbm", "catboost", "xgboost_poisson")]
    jobs = [(0, df, None, p) for p in settings]
    one = M.fit_boosted(jobs, ["a", "b"], ["grp"])
    monkeypatch.setattr(B, "BLOCK_ROWS", 90)
    monkeypatch.setattr(B, "ROUND", 2)
    many = M.fit_boosted(jobs, ["a", "b"], ["grp"])
    for m, k in zip(one, many):
        assert [len(t.values) for t in m.booster.trees] and len(m.booster.trees) == len(k.booster.trees) == 3
        got = df.select(m.column().alias("u"), k.column().alias("v")).collect()
        assert [r.u for r in got] == pytest.approx([r.v for r in got], abs=1e-9)


def test_groups_of_weeks_equal_separate_fits(spark):
    df = _panel(spark)
    weeks = sorted({r.yearweek for r in df.select("yearweek").collect()})
    groups = {0: weeks[:30], 1: weeks[:50], -1: weeks}
    pres, fixed = M.group_preprocess(df, groups, ["a", "b"], ["grp"])
    assert not fixed
    eqs = M.group_equations(df, groups, pres)
    for g, mine in groups.items():
        part = df.where(df.yearweek.isin(*mine))
        rows = part.collect()
        seen = [r.a for r in rows if r.a is not None]
        assert pres[g].medians["a"] == pytest.approx(median(seen))
        assert set(pres[g].levels["grp"]) == {"a", "b", "c"} and pres[g].modes["grp"] == pres[g].levels["grp"][0]
        # the features by hand
        fill = [[r.a if r.a is not None else median(seen), r.b] for r in rows]
        x = np.array(fill)
        x = (x - x.mean(0)) / x.std(0)
        hot = np.array([[float((r.grp or pres[g].modes["grp"]) == v) for v in pres[g].levels["grp"]] for r in rows])
        z, y = np.hstack([x, hot]), np.array([r["count"] for r in rows])
        zc = z - z.mean(0)
        w = np.linalg.solve(zc.T @ zc + np.eye(5), zc.T @ (y - y.mean()))
        assert eqs[g].ridge(1.0) == pytest.approx(w, abs=1e-8)
        model = M.LN.LinearModel.of(pres[g], eqs[g], w)
        got = [r.y_pred for r in model.predict(part).collect()]
        assert got == pytest.approx(list(y.mean() + zc @ w), abs=1e-8)
        for l1 in (0.15, 1.0):
            net = eqs[g].elastic_net(0.05, l1)
            grad = (zc.T @ (y - y.mean() - zc @ net)) / len(y) - 0.05 * (1 - l1) * net
            # optimal: the gradient is the penalty's where a weight is not 0, and no larger elsewhere
            assert np.abs(grad[net != 0] - 0.05 * l1 * np.sign(net[net != 0])).max(initial=0) < 1e-7
            assert np.abs(grad[net == 0]).max(initial=0) <= 0.05 * l1 + 1e-9


def test_grid_search_equals_single_fits(spark):
    df = _panel(spark, 1200)
    specs = {s.name: s for s in M.build_registry()}
    boosted = [{"max_iter": 2, "step_size": 0.03}, {"max_iter": 8, "step_size": 0.3}]
    best = M.grid_search(df, [specs["ridge"], specs["elasticnet"], specs["xgboost"]], ["a", "b"], ["grp"], "count", 2, {"xgboost": boosted})
    assert best["xgboost"] == boosted[1]
    folds = M._inner_folds(df, 2)
    for name in ("ridge", "elasticnet"):
        scores = []
        for params in M.grid_candidates(name):
            total = 0.0
            for weeks, valid in folds:
                m = M.fit_linear(df.where(df.yearweek.isin(*weeks)), ["a", "b"], ["grp"], "count", **params)
                rows = m.predict(valid, "p").collect()
                total += sum(abs(r["count"] - r.p) for r in rows) / sum(abs(r["count"]) for r in rows)
            scores.append(total)
        assert best[name] == M.grid_candidates(name)[int(np.argmin(scores))]


def test_failed_search_falls_back(spark, monkeypatch):
    df = _panel(spark, 1200)
    spec = next(s for s in M.build_registry() if s.name == "ridge")
    monkeypatch.setattr(M, "_best_candidate", lambda *a: 1 / 0)
    with pytest.warns(UserWarning, match="grid search failed"):
        model, best = M.fit_with_grid_search(spec, df, ["a", "b"], [], "count", 2)
    assert best is None and model.predict(df).count() == 1200


def test_grouped_medians(spark):
    rows = [("x", 1.0, None), ("x", 3.0, None), ("x", float("nan"), None), ("y", 2.0, 5.0), ("y", float("inf"), 7.0), ("y", 2.0, 6.0)]
    got = grouped_medians(spark.createDataFrame(rows, "g string, a double, b double"), ["a", "b"], "g")
    assert got == {"x": {"a": 2.0, "b": None}, "y": {"a": 2.0, "b": 6.0}}

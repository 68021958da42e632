import math
import re
from collections import Counter

import numpy as np
import pytest

from panelcast.llm import op11_balltree as B

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=10):
    held = [(i, Counter(words(t)), len(words(t))) for i, t in docs]
    n_docs, n_terms = sum(n > 0 for *_, n in held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in held:
            s = 0
            for t in words(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    s += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * (25 + 75 * n * n_docs // n_terms)))
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, k, None if null else i, -s) for k, (s, null, i) in enumerate(sorted(scored)[:top], 1)]
    return out


def items_of(spark, rows, kind="long"):
    return spark.createDataFrame(rows, f"item_id {kind}, text string").selectExpr("*", "'x' AS rank", "'y' AS item", "1 AS place")


def check(spark, docs, df, items, **kw):
    got = [tuple(r) for r in B.search(df, items_of(spark, items), **kw).collect()]
    assert sorted(got, key=str) == sorted(brute(docs, items), key=str)
    return got


def test_awkward_texts(spark, make, texts):
    items = [(1, "The the THE"), (2, None), (3, ""), (4, "shared1 shared2 öl ÖL 日本語"), (5, "nowhere"), (5, "a a w1x1"), (None, "🙂"), (7, "über-öl_wörterbuch")]
    check(spark, texts, make(texts), items, tree_rows=5, leaf=2)


@pytest.mark.parametrize("tree_rows,leaf", [(4096, 64), (50, 3), (7, 1)])
def test_random_texts_with_copies(spark, make, tree_rows, leaf):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(80)]
    docs = [(i, " ".join(rng.choice(vocabulary, rng.integers(0, 40)))) for i in range(300)]
    docs += [(1000 + i, docs[17][1]) for i in range(150)]
    items = [(j, " ".join(rng.choice(vocabulary, 12))) for j in range(25)]
    check(spark, docs, make(docs), items, tree_rows=tree_rows, leaf=leaf)


def test_items_in_blocks(spark, make, monkeypatch):
    docs = [(i, f"alpha w{i} w{i + 1} w{i % 5}") for i in range(60)]
    items = [(j, f"w{j} w{j + 1} alpha") for j in range(11)]
    monkeypatch.setattr(B, "item_blocks", lambda rows, most_items=3, most_terms=7, run=B.item_blocks: run(rows, most_items, most_terms))
    assert [len(b) for b in B.item_blocks(items_of(spark, items))] != [11]
    check(spark, docs, make(docs), items)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    x = np.zeros((600, 50))
    x[:, :] = rng.integers(0, 900_000, (600, 50)) * (rng.random((600, 50)) < 0.2)
    x[200:400] = x[7]  # equal rows are scored once
    x[400:] *= 0.01  # far from the best: left out
    x = np.floor(x)
    q = rng.integers(0, 14_000, (50, 9)) * (rng.random((50, 9)) < 0.3)
    tree = B.BallTree(x, 8)
    bound, scores = tree.bounds(q.astype(float)), x.astype(np.int64) @ q
    for node, (a, b) in enumerate(tree.ranges):
        assert (bound[node] >= scores[tree.order[a:b]].max(0)).all()
    best = B.Best(9)
    opened = B.search_tree(x, list(range(600)), q, best, 8)
    assert opened < 0.8 * sum(not c for c in tree.children) and sum(tree.equal) > 0
    for j in range(9):
        want = sorted(((-s, i) for i, s in enumerate(scores[:, j]) if s > 0))[:10]
        assert sorted((-s, p.id) for s, p in best.rows[j]) == want


def test_scores_beyond_doubles_are_exact():
    x = np.full((2, 9000), 999_999.0)
    q = np.full((9000, 1), (1 << 28) + 12345, np.int64)
    assert B.exact_scores(x, q)[0, 0] == 9000 * 999_999 * ((1 << 28) + 12345)


def test_string_ids_and_empty(spark, make):
    docs = spark.createDataFrame([("x", "alpha beta"), ("a", "alpha beta"), (None, "alpha beta"), ("z", "gamma")], "doc_id string, text string")
    got = [(r.item_id, r.rank, r.doc_id) for r in B.search(docs, items_of(spark, [("k", "beta")], "string")).orderBy("rank").collect()]
    assert got == [("k", 1, "a"), ("k", 2, "x"), ("k", 3, None)]
    assert B.search(make([]), items_of(spark, [(1, "beta")])).count() == 0
    empty = B.search(make([(1, "a")]), items_of(spark, []))
    assert empty.count() == 0 and empty.columns == ["item_id", "rank", "doc_id", "score"]

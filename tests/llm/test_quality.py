import itertools
import zlib

import numpy as np
import pytest

from panelcast.llm import op1_quality as Q

SF = "/root/testdata/sf0.01"


def test_forward_backward_by_enumeration():
    rng = np.random.default_rng(0)
    counts = [1, 4, 2, 6]
    first = np.concatenate([[0], np.cumsum(counts)])
    odds, change = rng.normal(size=first[-1]), rng.normal(size=(2, 2))
    good, expected, to = Q.forward_backward(odds, change, first, pairs=True)
    total = np.zeros((2, 2))
    for a, b in zip(first[:-1], first[1:]):
        weight = {}
        for y in itertools.product((0, 1), repeat=b - a):
            weight[y] = np.exp(sum(odds[a + t] * y[t] for t in range(b - a)) + sum(change[y[t - 1], y[t]] for t in range(1, b - a)))
        z = sum(weight.values())
        for t in range(b - a):
            assert good[a + t] == pytest.approx(sum(w for y, w in weight.items() if y[t]) / z)
        for y, w in weight.items():
            for t in range(1, b - a):
                total[y[t - 1], y[t]] += w / z
    assert expected == pytest.approx(total)
    assert len(to) == sum(c - 1 for c in counts)


def test_slope_of_the_score_by_enumeration():
    rng = np.random.default_rng(1)
    counts = [1, 4, 2, 6]
    first = np.concatenate([[0], np.cumsum(counts)])
    odds, change = rng.normal(size=first[-1]), rng.normal(size=(2, 2))
    share = np.concatenate([w / w.sum() for w in (rng.random(c) for c in counts)])
    chance, given, plain, given_pairs, plain_pairs, to = Q.given_drawn(odds, change, first, share)
    place = {t: k for k, t in enumerate(to.tolist())}
    for k, (a, b) in enumerate(zip(first[:-1], first[1:])):
        any_ = {
            y: np.exp(sum(odds[a + t] * y[t] for t in range(b - a)) + sum(change[y[t - 1], y[t]] for t in range(1, b - a)))
            for y in itertools.product((0, 1), repeat=b - a)
        }
        told = {y: w * sum(share[a + t] for t in range(b - a) if y[t]) for y, w in any_.items()}
        assert chance[k] == pytest.approx(sum(told.values()) / sum(any_.values()))
        for weight, line, pairs in ((told, given, given_pairs), (any_, plain, plain_pairs)):
            z = sum(weight.values())
            for t in range(b - a):
                assert line[a + t] == pytest.approx(sum(w for y, w in weight.items() if y[t]) / z)
            for t in range(1, b - a):
                want = np.zeros((2, 2))
                for y, w in weight.items():
                    want[y[t - 1], y[t]] += w / z
                assert pairs[place[a + t]] == pytest.approx(want)
    # the chance is the length-weighted mean of the marginals, and its slope is as said
    score = lambda o: np.add.reduceat(Q.forward_backward(o, change, first) * share, first[:-1])
    assert chance == pytest.approx(score(odds))
    for i in range(len(odds)):
        step = np.eye(len(odds))[i] * 1e-6
        k = np.searchsorted(first, i, "right") - 1
        assert (score(odds + step) - score(odds - step))[k] / 2e-6 == pytest.approx(chance[k] * (given[i] - plain[i]), abs=1e-6)


def test_hidden_lines_are_told_apart():
    """Rejected documents hold good lines too, of a small share of their length: those score above the bad ones beside them."""
    rng = np.random.default_rng(2)
    texts, labels, truth = [], [], []
    for k in range(300):
        bad = k % 2
        lines = [bad and rng.random() < 0.6 for _ in range(8)]
        texts.append("\n".join("BUY!!! NOW!!! 99 | " * 6 if b else "the river runs by the old mill" for b in lines))
        labels.append(1 - bad)
        truth.append([0 if b else 1 for b in lines])
    x, weight, first = Q.line_features(*arrays(texts))
    cut = list(zip(first[:-1], first[1:]))
    field = Q.fit([x[a:b] for a, b in cut], [weight[a:b].astype(float) for a, b in cut], labels)
    good, _, _ = field.line_probabilities(*arrays(texts))
    found = [good[a:b] for a, b in cut]
    inside = [(f[i], t[i]) for f, t, y in zip(found, truth, labels) if y == 0 for i in range(8) if 0 < sum(t) < 8]
    assert np.mean([g for g, t in inside if t]) > np.mean([g for g, t in inside if not t]) + 0.1
    assert np.mean((field.scores(*arrays(texts)) >= 0.5) == np.array(labels)) > 0.95


def arrays(texts):
    raw = [t.encode() for t in texts]
    return np.concatenate([[0], np.cumsum([len(r) for r in raw])]), np.frombuffer(b"".join(raw), np.uint8)


def test_lines_and_features():
    texts = ["a b\nC\n", "", "x x x", "\n", "é"]
    starts, first = Q.lines_of(*arrays(texts))
    assert np.diff(first).tolist() == [t.count("\n") + 1 for t in texts]
    x, weight, _ = Q.line_features(*arrays(texts))
    lines = [line for t in texts for line in t.split("\n")]
    assert weight.tolist() == [len(line.encode()) + 1 for line in lines]
    assert x[4, 10] == pytest.approx(2 / 3) and np.isfinite(x).all()  # "x x x": two words said again
    alone = np.concatenate([Q.line_features(*arrays([t]))[0] for t in texts])
    assert alone == pytest.approx(x)  # a text's features don't depend on what else is in the batch


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = Q.classify(docs, labels).toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    both = got.merge(labels.toPandas(), on="doc_id")
    held = both[both.held_out]
    assert (held.predicted == held.quality).mean() > 0.95
    kept = Q.keep_good(docs, Q.learn(docs, labels))
    assert kept.columns == docs.columns and set(kept.toPandas().doc_id) == set(got[got.predicted == 1].doc_id)


def test_awkward_rows(spark, make, texts):
    df = make(texts)
    labels = spark.createDataFrame([(7, 1, 0), (8, 0, 0), (9, 1, None), (None, 0, 0), (5, None, 0), (77, 1, 1)], "doc_id long, quality int, toxic int")
    got = Q.classify(df, labels).collect()
    assert sorted((r.doc_id for r in got), key=str) == sorted((i for i, _ in texts), key=str)
    same = [r.score for r in got if r.doc_id in (2,)] + [r.score for r in got if r.doc_id == 1]
    assert len(set(same)) == 1  # null and empty alike
    none = labels.limit(0)
    assert {r.score for r in Q.classify(df, none).collect()} == {0.5}
    assert Q.classify(make([]), labels).count() == 0 and Q.classify(make([]), none).count() == 0
    kept = Q.keep_good(df, Q.Field(0.9))
    assert kept.columns == df.columns and kept.count() == len(texts)
    lines = Q.label_lines(df, Q.Field(0.9)).count()
    assert lines == sum((t or "").count("\n") + 1 for _, t in texts)

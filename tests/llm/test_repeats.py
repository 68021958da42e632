import collections
import hashlib
import random
import re

import numpy as np
import pytest

from panelcast.llm import op5_debruijn as D
from panelcast.llm import op10_lpf as L
from panelcast.llm.anchors import runs, span_hashes, window_minima
from panelcast.llm.repeats import Unit


def covered(units, length, keep_first=False):
    count, seen, out = collections.Counter(), set(), []
    for u in units:
        count.update(u[i : i + length] for i in range(len(u) - length + 1))
    for u in units:
        c = np.zeros(len(u), bool)
        for i in range(len(u) - length + 1):
            w = u[i : i + length]
            c[i : i + length] |= (w in seen) if keep_first else count[w] > 1
            seen.add(w)
        out.append(c)
    return out


def corpus(seed, n=40):
    """Random words with passages, exact and near copies, lines said again and again."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcé🙂") for _ in range(rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(rng.randint(20, 90))) for _ in range(4)]
    rows = []
    for i in range(n):
        parts = [" ".join(word() for _ in range(rng.randint(0, 60)))]
        for _ in range(rng.randint(0, 3)):
            w = rng.choice(passages).split()
            if rng.random() < 0.5:
                w[rng.randrange(len(w))] = word()
            parts.append(" ".join(w[rng.randrange(5) :]))
            parts.append(" ".join(word() for _ in range(rng.randint(0, 20))))
        rows.append((i, rng.choice([" ", "\n", "  \t"]).join(parts)))
    return rows + [(n, rows[0][1]), (n + 1, "same words " * 80)]


def words(text):
    return tuple(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_words_as_brute_force(make, texts, keep_first, seed):
    rows = sorted(corpus(seed), key=lambda r: r[0]) + [(None if i is None else i + 1000, t) for i, t in texts]
    if keep_first:
        rows = [r for r in rows if r[0] is not None and r[0] != 1002]  # an order that is plain: by id
    units = [words(t) for _, t in rows]
    want = [
        (i, len(u), int(c.sum()), hashlib.sha256(" ".join(w for w, x in zip(u, c) if not x).encode()).hexdigest())
        for (i, _), u, c in zip(rows, units, covered(units, 35, keep_first))
    ]
    got = [tuple(r)[:4] for r in D.digests(D.cut(make(rows), keep_first=keep_first)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(w[2] for w in want) > 500


def compacted(units, length):
    """Nonbranching paths of repeated windows, as sorted lists of windows, from dictionaries."""
    count = collections.Counter(u[i : i + length] for u in units for i in range(len(u) - length + 1))
    edges = {e for e, c in count.items() if c > 1}
    outs, ins = collections.defaultdict(list), collections.defaultdict(list)
    for e in edges:
        outs[e[:-1]].append(e)
        ins[e[1:]].append(e)
    through = {v for v in outs if len(outs[v]) == 1 and len(ins[v]) == 1}
    paths, left = [], set(edges)
    for e in [x for x in edges if x[:-1] not in through] + sorted(edges):  # starts of paths, then circles
        path = []
        while e in left:
            left.discard(e)
            path.append(e)
            if e[1:] not in through:
                break
            e = outs[e[1:]][0]
        if path:
            paths.append(path)
    return paths


@pytest.mark.parametrize("length,gram", [(35, 12), (9, 3)])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_paths_as_compacted_by_brute_force(make, seed, length, gram):
    rows = corpus(seed, 30) + [(500, "a b c d e " * 30), (501, "p " * 50), (502, "x1 x2 " + "p " * 40)]
    if seed == 3:  # few words: many branches and circles
        rng = random.Random(9)
        rows += [(600 + i, " ".join(rng.choice("abc") for _ in range(rng.choice((1, 30, 34, 35, 90))))) for i in range(40)]
    units = {i: words(t) for i, t in rows}
    want = compacted(list(units.values()), length)
    got = collections.defaultdict(list)
    for r in D.paths(make(rows), length, gram).collect():
        u = units[r.doc_id][r.word : r.word + r.n_words]
        got[tuple(r.path)].append((r.ordinal, [u[k : k + length] for k in range(r.n_words - length + 1)]))
    paths = []
    for parts in got.values():
        parts.sort(key=lambda p: p[0])
        assert [p[0] for p in parts] == list(range(len(parts)))
        path = [e for _, es in parts for e in es]
        assert all(a[1:] == b[:-1] for a, b in zip(path, path[1:]))
        paths.append(path)
    assert sorted(map(sorted, paths)) == sorted(map(sorted, want))
    assert len(want) > 3


def spans(c):
    return int(np.count_nonzero(np.diff(np.concatenate([[0], c.astype(int)])) == 1))


@pytest.mark.parametrize("group", [8192, 1])
def test_bytes_as_brute_force(make, texts, group):
    rows = corpus(3) + [(None if i is None else i + 1000, t) for i, t in texts]
    units = [(t or "").encode() for _, t in rows]
    want = [
        (i, len(u), int(c.sum()), spans(c), hashlib.sha256(np.frombuffer(u, np.uint8)[~c].tobytes()).hexdigest())
        for (i, _), u, c in zip(rows, units, covered(units, 200))
    ]
    got = [tuple(r) for r in L.digests(L.cut(make(rows), group=group)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("group", [8192, 1])
def test_keep_first_as_brute_force(make, group):
    rows = [r for r in corpus(4)]
    units = [t.encode() for _, t in rows]
    # order within the operator: id, then position
    want = {i: (len(u), int(c.sum())) for (i, _), u, c in zip(rows, units, covered(units, 200, keep_first=True))}
    got = {r.doc_id: (r.n_bytes, r.n_removed) for r in L.cut(make(rows), keep_first=True, group=group).collect()}
    assert got == want


def test_keep_first_cuts_later_rows_of_equal_id_and_text(make):
    long_ = "é🙂 " + " ".join(f"v{i * i % 997}" for i in range(200))
    rows = [(None, long_)] * 3 + [(1, "other words " + long_)] * 2 + [(2, "short")] * 2 + [(3, long_[:300])]
    want = [(i, int(c.sum())) for (i, _), c in zip(rows, covered([t.encode() for _, t in rows], 200, keep_first=True))]
    got = [(r.doc_id, r.n_removed) for r in L.cut(make(rows), keep_first=True).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = sorted(len(r.text) for r in L.dedup(make(rows)).collect() if r.doc_id is None)
    assert kept == [0, 0, len(long_)]


def test_dedup_returns_documents(make, texts):
    df = make(texts)
    out = L.dedup(df)
    assert out.columns == df.columns and [f.dataType for f in out.schema] == [f.dataType for f in df.schema]
    got = sorted(((r.doc_id, r.text, r.n_chars) for r in out.collect()), key=str)
    assert len(got) == len(texts)
    assert all((t is None) == (n is None) and (t is None or len(t) == n) for _, t, n in got)
    long_ = dict(texts)[5]
    assert (5, long_, len(long_)) in got  # the first copy stays
    assert all(t == "" for i, t, _ in got if i == 6)


@pytest.mark.parametrize("keep_first", [False, True])
def test_copies_of_a_row_bring_each_run_once(make, keep_first):
    from panelcast.llm.repeats import keyed, marked, run_rows

    unit = Unit(False, L.LENGTH, L.GRAM)
    text = " ".join(f"w{i * i % 1009}" for i in range(300)) + " said again" * 60
    rows = [(None, text)] * 40 + [(7, text)] * 40 + [(8, "x" + text)]
    got = marked(keyed(make(rows)), unit, L.shared_factors, keep_first=keep_first).selectExpr("size(runs) AS n").collect()
    assert len(got) == 81 and max(r.n for r in got) <= len(run_rows(("x" + text).encode(), unit))


def test_suffix_ranks_order_suffixes():
    rng = np.random.default_rng(2)
    for length in (3, 8, 20, 200):
        data = rng.integers(97, 99, 300).astype(np.uint8)
        raw = data.tobytes() + bytes(length)
        ranks = L.suffix_ranks(data, length)
        order = np.lexsort((np.arange(300), ranks)).tolist()
        assert order == sorted(range(300), key=lambda i: (raw[i : i + length], i))


def test_previous_smaller_as_a_loop():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 7, 64, 301):
        for values in (rng.permutation(n), np.arange(n), np.arange(n)[::-1].copy()):
            want = [next((j for j in range(i - 1, -1, -1) if values[j] < values[i]), -1) for i in range(n)]
            assert L.previous_smaller(values).tolist() == want


@pytest.mark.parametrize("length", [1, 5, 8, 20, 37])
def test_longest_previous_factors_by_brute_force(length):
    rng = np.random.default_rng(length)
    texts = [b"abracadabra abracadabra cadabra abra" * 2, b"a" * 90, bytes(rng.integers(97, 99, 200).astype(np.uint8)), bytes(200)]
    passage = bytes(rng.integers(97, 123, 60).astype(np.uint8))
    texts.append(passage + b"-" + passage[5:] + b"+" + passage)
    for raw in texts:
        data = np.frombuffer(raw, np.uint8)
        every = np.arange(len(raw) - length + 1)
        for starts in (every, every[rng.random(len(every)) < 0.4]):
            other, earlier = L.previous_factors(data, starts, L.doubled_ranks(data, length))

            def shared(i, j):
                return next((k for k in range(length) if raw[i + k] != raw[j + k]), length)

            at = starts.tolist()
            assert earlier.tolist() == [max((shared(i, j) for j in at if j < i), default=0) for i in at]
            assert other.tolist() == [max((shared(i, j) for j in at if j != i), default=0) for i in at]


def test_runs_cover_every_window_with_its_smallest_gram():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 60, 500, dtype=np.uint64)
    first, count, anchor = runs(h, 24)
    assert count.sum() == 500 - 23 and (count <= 24).all()
    for f, c, a in zip(first, count, anchor):
        for i in range(f, f + c):
            assert h[i : i + 24].min() == h[a]
    assert (window_minima(h, 24) == [h[i : i + 24].min() for i in range(477)]).all()
    data = rng.integers(0, 255, 90).astype(np.uint8)
    twice = np.concatenate([data, data])
    a = span_hashes(twice, np.arange(90), np.arange(90) + 90)
    assert span_hashes(twice, np.array([3, 93]), np.array([13, 103])).tolist()[0] == span_hashes(data, np.array([3]), np.array([13]))[0]
    assert len(set(a.tolist())) == 90


def test_units():
    assert Unit(False, 200, 73).longs == 2 and Unit(True, 35, 12).width == 24


def test_empty(make):
    assert D.cut(make([])).count() == 0 and L.cut(make([])).count() == 0 and L.dedup(make([])).count() == 0


def test_runs_in_blocks_are_the_runs_of_the_whole():
    import numpy as np

    from panelcast.llm.anchors import runs

    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 2**40, 5000).astype(np.uint64) << np.uint64(20)
    hashes[100:400] = hashes[100]  # ties
    whole = runs(hashes, 24)
    for bits in (6, 8, 11):
        assert all((a == b).all() for a, b in zip(whole, runs(hashes, 24, bits)))

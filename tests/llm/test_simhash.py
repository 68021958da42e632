import random
import re

import numpy as np
import xxhash

from panelcast.llm import op7_simhash as S
from panelcast.llm.components import components


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_groups(rows, most=3):
    f = np.array([brute_fingerprint(t) for _, t in rows], np.uint64)
    root = list(range(len(f)))

    def find(z):
        while root[z] != z:
            z = root[z]
        return z

    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f ^ f[i]) <= most).tolist():
            root[find(j)] = find(i)
    best = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            best[find(k)] = min(best.get(find(k), i), i)
    return [(i, format(int(f[k]), "016x"), best.get(find(k))) for k, (i, _) in enumerate(rows)]


def near_copies(n, seed=5):
    rng = random.Random(seed)
    base = [f"word{rng.randrange(400)}" for _ in range(300)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = "changed"
        rows.append((100 + i, " ".join(w)))
    return rows


def test_link_as_brute_force(make, texts):
    rows = texts + near_copies(60)
    got = sorted(map(tuple, S.link(make(rows)).collect()), key=str)
    assert got == sorted(brute_groups(rows), key=str)
    assert sum(c is not None and c != i for i, _, c in got) > 10


def test_hot_keys_are_dealt_out(spark):
    rng = random.Random(1)
    fps = sorted({(1 << 62) ^ (rng.getrandbits(9) << rng.randrange(50)) for _ in range(300)})
    df = spark.createDataFrame([(x, i) for i, x in enumerate(fps)], "fp long, doc_id long")
    split = {(r.fp, r.component_id) for r in S.groups(df, 3, key_share=7).collect()}
    whole = {(r.fp, r.component_id) for r in S.groups(df, 3).collect()}
    assert split == whole and len(whole) == len(fps)


def test_pivots_never_discard_a_link():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    y = x.copy()
    for _ in range(3):
        y ^= np.uint64(1) << rng.integers(0, 64, 500, dtype=np.uint64)
    for p in S.PIVOTS:
        d = np.bitwise_count(x ^ np.uint64(p)).astype(int) - np.bitwise_count(y ^ np.uint64(p)).astype(int)
        assert np.abs(d).max() <= 3


def test_keep_one(make, texts):
    rows = texts + near_copies(20)
    df = make(rows)
    kept = S.keep_one(df)
    assert kept.columns == df.columns
    got = sorted((r.doc_id for r in kept.collect()), key=str)
    groups = {c for _, _, c in brute_groups(rows)}
    assert got == sorted(groups, key=str)


def test_components_of_long_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 50)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + k: 100 for k in range(50)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty(make):
    assert S.link(make([])).count() == 0
    assert S.keep_one(make([])).count() == 0

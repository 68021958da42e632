import numpy as np
import pytest

from panelcast.llm import op3_licences as L

SF = "/root/testdata/sf0.01"
LINES = {
    "apache": "Licensed under the Apache License, Version 2.0.",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "gpl": "This work is licensed under the GNU General Public License, version 3.",
    "mit": "Released under the MIT License.",
}


@pytest.fixture(scope="module")
def model(spark):
    return L.learn(spark.read.parquet(f"{SF}/documents.parquet"))


def test_templates_are_told_apart(model):
    for family, texts in L.TEMPLATES.items():
        for t in texts:
            raw = t.encode()
            found = model.scan(np.array([0, len(raw)]), np.frombuffer(raw, np.uint8))
            assert [f[2] for f in found] == [family]


def test_corpus_lines(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r.families for r in L.scan(docs, model).collect()}
    want = {r.doc_id: ",".join(f for f, line in LINES.items() if line in r.text) for r in docs.collect()}
    assert len(got) == len(want)
    assert np.mean([got[i] == want[i] for i in want]) > 0.995


def test_variants_and_unknown(make, model):
    rows = [
        (1, "Some text.\nReleased under the terms of the MIT License.\nMore."),
        (2, "The licence of love and the version of the story, 2.0 times told"),
        (3, "Licensed under the Frobnicate Public License, Version 9.9."),
        (4, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ]
    got = {r.doc_id: r for r in L.scan(make(rows), model).collect()}
    assert got[1].families == "mit" and got[4].families == "mit" and got[2].families == "" and got[3].families == ""
    assert got[3].n_unknown == 1 and got[2].n_unknown == 0


def found(model, text):
    raw = text.encode()
    return [f[2] for f in model.scan(np.array([0, len(raw)]), np.frombuffer(raw, np.uint8))]


def test_families_left_out_are_unknown(spark, monkeypatch):
    """A model that never saw a family calls its texts unknown (or none where they say nothing of a licence), not by another's name."""
    lines = [line for r in spark.read.parquet(f"{SF}/documents.parquet").limit(1500).collect() for line in r.text.split("\n")][:3000]
    left = {f: L.TEMPLATES[f] for f in ("epl", "mpl")}
    monkeypatch.setattr(L, "TEMPLATES", {f: t for f, t in L.TEMPLATES.items() if f not in left})
    monkeypatch.setattr(L, "FAMILIES", sorted(L.TEMPLATES))
    monkeypatch.setattr(L, "NONE", len(L.TEMPLATES))
    model = L.fit(lines)
    got = [found(model, t) for texts in left.values() for t in texts]
    assert all(g in ([], [L.UNKNOWN]) for g in got) and sum(g == [L.UNKNOWN] for g in got) >= len(got) / 2
    assert found(model, LINES["mit"]) == ["mit"]


def test_scores_as_by_hand(model):
    """Scores of paragraphs from loops over their words, one n-gram at a time."""
    texts = ["Released under the MIT License.", "a", "", "this Work is licensed, or not\nunder the GNU", LINES["gpl"]]
    raw = [t.encode() for t in texts]
    at, data = np.concatenate([[0], np.cumsum([len(r) for r in raw])]), np.frombuffer(b"".join(raw), np.uint8)
    got = model.scores(*L.ngrams(at, data)[:3])
    k = 0
    for text in texts:
        for line in text.split("\n"):
            h = [L.span_hashes(np.frombuffer(x.encode(), np.uint8), np.array([0]), np.array([len(x)])) for x in L.words(line)]
            total, n = np.zeros(len(model.bias)), 0
            for size in (1, 2, 3):
                for i in range(len(h) - size + 1):
                    gram = h[i].copy()
                    for x in h[i + 1 : i + size]:
                        gram = L.mixed(gram * np.uint64(0x9E3779B97F4A7C15) + x)
                    row = model.weights[int(gram[0] >> np.uint64(48))].astype(float)
                    n += bool(row.any())
                    total += row
            assert got[k] == pytest.approx(total / np.sqrt(max(1, n)) + model.bias, abs=1e-3)
            k += 1
    assert k == len(got)

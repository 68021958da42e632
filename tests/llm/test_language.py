import zlib

import numpy as np
import pyarrow as pa

from panelcast.llm import op9_language as L

SF = "/root/testdata/sf0.01"


def test_counts_do_not_cross_texts():
    texts = ["abc def", "", "Z", "123", "été"]
    whole = np.concatenate([c for _, c in L.count_blocks(pa.array(texts))])
    alone = np.concatenate([c for t in texts for _, c in L.count_blocks(pa.array([t]))])
    assert (whole == alone).all()
    assert whole.sum(1).tolist()[1] == 0 and whole.sum(1).tolist()[3] == 0 and whole.sum(1).tolist()[2] > 0


def test_clusters_are_unit_and_cover():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(m, 0.01, (20, 3)) for m in ((1, 0, 0), (0, 1, 0), (0, 0, 1))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    c = L.clusters(x, 3)
    assert np.allclose(np.linalg.norm(c, axis=1), 1) and (x @ c.T).max(1).min() > 0.99


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = L.identify(docs, L.learn(docs)).toPandas()
    both = got.merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    held = both[both.held_out]
    assert (held.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in held.doc_id]).all()
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert got.score.between(0, 1).all() and got.rejected.mean() < 0.05


def test_awkward_rows(make, texts):
    rows = [(i, t, None if i == 3 else "de" if i == 4 else "en") for i, t in texts] + [(30, "123 456 ...", "en"), (31, "مرحبا بالعالم", None)]
    got = {}
    model = L.learn(make(rows))
    for r in L.identify(make(rows), model).collect():
        got.setdefault(r.doc_id, []).append(r.lang_pred)
    assert sum(map(len, got.values())) == len(rows)
    assert got[1] == ["und"] and got[2] == ["und", "und"] and got[30] == ["und"] and got[10] == ["und"]
    assert got[31][0] in model.languages
    assert {r.lang_pred for r in L.identify(make(rows), None).collect()} == {"und"}
    assert L.learn(make([])) is None and L.identify(make([]), model).count() == 0


def test_far_texts_are_rejected(spark, make):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = L.learn(docs)
    got = L.identify(make([(1, "Ωμέγα και άλφα, γράμματα ελληνικά παντού"), (2, docs.first().text)]), model).collect()
    assert {r.doc_id: r.rejected for r in got}[1]

import __spark_entry__ as E
import corpus_pipeline as P
from panelcast.llm import op4_decontaminate, op7_simhash, op10_lpf
from panelcast.llm.common import store

SF = "/root/testdata/sf0.01"


def test_registered():
    names = E.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {q.split("_")[0] for q in names} and "pipeline" in names
    assert P.ORACLE_SQL is None and len(P.STAGES) == 5


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes, stage_docs = [docs.count()], [docs]
    for name, stage in P.STAGES:
        out = store(stage(spark, stage_docs[-1], SF), name)
        sizes.append(out.count())
        stage_docs.append(out)
        if name != "tokens":
            assert out.columns == docs.columns
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] > sizes[4] == sizes[5] > 0.7 * sizes[0]
    _, good, single, cut, clean, tokens = stage_docs
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = {r.doc_id for r in good.collect()}
    assert sum((i in left) == (q == 1) for i, q in labels.items()) > 0.98 * len(labels)
    linked = op7_simhash.link(good).collect()
    assert {r.doc_id for r in single.collect()} == {r.component_id for r in linked}
    assert sum(r.n_removed for r in op10_lpf.cut(cut, keep_first=True).select("n_removed").collect()) < 0.02 * sum(r.n_chars for r in cut.collect())
    leaks = {r.doc_id for r in op4_decontaminate.find(cut, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in cut.collect()} - leaks
    assert P.run(spark, SF).count() == sizes[-1] == len({r.doc_id for r in tokens.collect()})


def test_empty_and_clashing_columns(spark, make, texts, tmp_path):
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{table}.parquet").write.parquet(str(tmp_path / f"{table}.parquet"))
    for rows in ([], texts):
        docs = make(rows)
        names = docs.columns
        for name, stage in P.STAGES:
            docs = store(stage(spark, docs, str(tmp_path)), name)
            assert name == "tokens" or docs.columns == names
        assert docs.count() <= len(rows)

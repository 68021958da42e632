import hashlib
import zlib

import pytest

from panelcast.llm import op12_manifest as M


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row, text):
    fields = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def tree(nodes, fanout):
    """Levels of digests from the nodes to the one on top."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + fanout])) for i in range(0, len(out[-1]), fanout)])
    return out


def brute(rows, fanout):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for lang in langs:
        groups[lang] = sorted(groups[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
    trees = {lang: tree([leaf(r, r["text"]) for r in groups[lang]], fanout) for lang in langs}
    upper = tree([trees[lang][-1][0] for lang in langs], fanout)
    out = []
    for g, lang in enumerate(langs):
        for i, r in enumerate(groups[lang]):
            text = r["text"]
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded, proof = leaf(r, text), ""
            for levels, at in ((trees[lang], i), (upper, g)):
                for level in levels[:-1]:
                    low = at // fanout * fanout
                    left, right = "".join(level[low:at]), "".join(level[at + 1 : low + fanout])
                    folded, proof, at = sha(left + folded + right), proof + left + right, at // fanout
            out.append((r["doc_id"], leaf(r, r["text"]), trees[lang][-1][0], upper[-1][0], sha(proof), folded, folded == upper[-1][0]))
    return out


def check(df, fanout=8):
    want = brute([r.asDict() for r in df.collect()], fanout)
    got = [tuple(r) for r in M.manifest(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    return got


def test_awkward_rows(make, texts):
    rows = [(i, t, (None, "en", "de", "", "zh", "日本")[k % 6] if k < 15 else "en") for k, (i, t) in enumerate(texts)]
    got = check(make(rows))
    assert len({g[3] for g in got}) == 1 and not all(g[6] for g in got)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 65])
def test_one_language(make, n):
    got = check(make([(i * 7, f"Text {i}", "en") for i in range(n)]))
    assert {g[2] for g in got} == {got[0][3]}


@pytest.mark.parametrize("fanout", [2, 3])
def test_high_trees(make, monkeypatch, fanout):
    """Ten levels and more, so that pointers jump by 1, 2, 4 and 8 with copies of the ancestors."""
    monkeypatch.setattr(M, "FANOUT", fanout)
    check(make([(i, f"T{i}", "en" if i % 3 else f"l{i % 40}") for i in range(700)]), fanout)


def test_many_equal_rows(make):
    got = check(make([(5, "Same", "en")] * 300 + [(None, "Same", "en")] * 100 + [(None, f"Other {i}", None) for i in range(30)]))
    assert len(got) == 430


def test_other_ids_and_empty(spark, make):
    rows = [("b", "X", "en", "s", 1), ("a", "Y", "en", "s", 1)]
    df = spark.createDataFrame(rows, "doc_id string, text string, lang string, source string, n_chars int")
    first = M.manifest(df).where("doc_id = 'a'").first()
    assert first.leaf == sha("1:a1:s2:en1:11:Y")
    empty = M.manifest(make([]))
    assert empty.count() == 0 and empty.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_no_python_in_the_plan(make, texts):
    plan = M.manifest(make(texts, extra=False))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))

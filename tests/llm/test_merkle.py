import hashlib

import pytest
from pyspark.sql import functions as F

from panelcast.llm import op2_merkle as M
from panelcast.llm.neighbours import with_next


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute_runs(paragraph):
    out, now = [], []
    for w in paragraph.split(" "):
        now.append(w)
        if hashlib.md5(w.encode()).hexdigest() < "4":
            out.append(" ".join(now))
            now = []
    return out + [" ".join(now)] if now else out


def brute_leaves(text):
    return {r for p in (text or "").split("\n") for r in brute_runs(p)} - {""}


def brute_like(x, y):
    a, b = brute_leaves(x), brute_leaves(y)
    return 1.0 if x == y else 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


def brute_root(text):
    sections, now = [], []
    for p in (text or "").split("\n"):
        now.append(sha(" ".join(map(sha, brute_runs(p)))))
        if now[-1][0] == "0":
            sections.append(now)
            now = []
    if now:
        sections.append(now)
    return sha(" ".join(sha(" ".join(s)) for s in sections))


def test_contract_columns_by_brute_force(make, texts):
    rows = sorted(texts, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    for bucket_rows in (512, 2):
        got = [tuple(r) for r in M.edited_pairs(make(texts), bucket_rows=bucket_rows).collect()]
        want = []
        for (i, t), (_, nxt) in zip(rows, rows[1:] + rows[:1]):
            t, nxt = t or "", nxt or ""
            edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
            want.append((i, len(t), sha(edited), brute_root(t), brute_root(edited), brute_like(t, edited), brute_like(t, nxt)))
        assert sorted(got, key=str) == sorted(want, key=str)


def test_one_word_put_in_keeps_likeness(make):
    words = [f"word{i * i % 1013}x{i}" for i in range(400)]
    at = {"front": 0, "middle": 200, "end": 400}
    rows = [(1, " ".join(words))] + [(2 + k, " ".join(words[:i] + ["new"] + words[i:])) for k, i in enumerate(at.values())]
    marks = make(rows).select("doc_id", M.mark(F.col("text")).alias("m"))
    first = marks.where("doc_id = 1").select(F.col("m").alias("one"))
    got = marks.where("doc_id > 1").join(F.broadcast(first)).select(M.likeness(F.col("m"), F.col("one")).alias("x")).collect()
    assert len(got) == 3 and all(0.9 < r.x < 1 for r in got)


def test_edits_are_near_and_strangers_far(make):
    rows = [(k, "\n".join(" ".join(f"w{k}_{i}_{j}" for j in range(12)) for i in range(20))) for k in range(6)]
    for r in M.edited_pairs(make(rows)).collect():
        assert 0.3 < r.near_edited < 0.8 and r.near_next == 0


def test_equal_and_changed_branches(make):
    lines = [f"paragraph number {i} says {i * i}" for i in range(60)]
    a = M.fingerprints(make([(1, "\n".join(lines)), (2, "same")]))
    lines[37] = "edited"
    b = M.fingerprints(make([(1, "\n".join(lines)), (2, "same")]))
    got = {r.doc_id: r for r in M.changed(a, b).collect()}
    assert not got[1].equal and got[1].paragraphs_a == [37] and got[1].paragraphs_b == [37] and len(got[1].sections_a) >= 1
    assert got[2].equal and got[2].paragraphs_a == [] and got[2].sections_b == []


def test_changed_counts_copies_and_places(make):
    versions = [
        ("A A C", "A C", [1], []), ("A B C", "C B A", [1, 2], [0, 1]), ("A B", "A B B", [], [2]), ("A", "B", [0], [0]),
        ("A B C D", "A C B D E", [2], [1, 4]), ("A", "A", [], []),
    ]
    def trees(side):
        return M.fingerprints(make([(k, v[side].replace(" ", "\n")) for k, v in enumerate(versions)] + [(100 + side, "only here")]))

    got = {r.doc_id: r for r in M.changed(trees(0), trees(1)).collect()}
    assert sorted(got) == list(range(len(versions)))
    for k, (a, b, pa, pb) in enumerate(versions):
        assert got[k].equal == (a == b) and (got[k].paragraphs_a, got[k].paragraphs_b) == (pa, pb)
        assert bool(got[k].sections_a or got[k].sections_b) == (a != b)


def test_many_paragraphs_without_a_border(make):
    text = "again\n" * 20_000
    assert M.fingerprints(make([(1, text)])).first().root == brute_root(text)


@pytest.mark.parametrize("ids", [[5], [1, 2], list(range(0, 4000, 7)), [2**40 + i for i in range(50)] + [1, 2, 3], [4, 4, 4, 9, None, None]])
def test_next_rows(spark, ids):
    df = spark.createDataFrame([(i, f"t{k}") for k, i in enumerate(ids)], "doc_id long, text string")
    got = [(r.doc_id, r.text, r.next.t) for r in with_next(df, "doc_id", ["text"], {"t": F.col("text")}, bucket_rows=3).collect()]
    rows = sorted(((i, f"t{k}") for k, i in enumerate(ids)), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert sorted(got, key=str) == sorted([(i, t, n) for (i, t), (_, n) in zip(rows, rows[1:] + rows[:1])], key=str)


def test_no_python_in_the_plan(make, texts):
    plan = M.edited_pairs(make(texts, extra=False))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_empty(make):
    assert M.edited_pairs(make([])).count() == 0

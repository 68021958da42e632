import random

from panelcast.llm import op4_decontaminate as D


def distance(item, text):
    column, best = list(range(len(item) + 1)), len(item)
    for c in text:
        now = [0]
        for i, p in enumerate(item, 1):
            now.append(min(column[i] + 1, now[-1] + 1, column[i - 1] + (p != c)))
        column = now
        best = min(best, column[-1])
    return best


def test_myers_as_dynamic_programming():
    rng = random.Random(1)
    for _ in range(400):
        item = "".join(rng.choice("abc") for _ in range(rng.randint(1, 80)))
        text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 70)))
        if rng.random() < 0.5:
            text = text[:20] + item[:50] + text[20:]
        assert D.Pattern(item).best(text)[0] == distance(item, text)


def fixture():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    items = [(k, " ".join(word() for _ in range(rng.randint(5, 40)))) for k in range(12)] + [(50, ""), (51, None), (52, "a"), (53, "Tie item text"), (54, "Tie item text")]
    docs = []
    for i in range(60):
        text = " ".join(word() for _ in range(rng.randint(0, 60)))
        if rng.random() < 0.6:
            item = list(rng.choice(items[:12])[1].upper())
            for _ in range(rng.randint(0, len(item) // 8)):
                k = rng.randrange(len(item))
                item[k : k + 1] = rng.choice(["", "x", "yz"])
            text += "\n  " + "".join(item) + "\t" + word()
        docs.append((i, text))
    return items, docs + [(60, None), (61, ""), (62, "so tie  ITEM text"), (62, "so tie  ITEM text")]


def test_find_and_drop_as_brute_force(spark, make):
    items, rows = fixture()
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    want = []
    for i, t in rows:
        for k, item in items:
            norm = D.normal(item or "")
            if norm and t:
                d = distance(norm, D.normal(t))
                if d <= D.budget(norm):
                    want.append((i, k, d))
    for block in (4_000_000, 200):
        got = [(r.doc_id, r.item_id, r.distance) for r in D.find(make(rows), bench, block_chars=block).collect()]
        assert sorted(got) == sorted(want) and len(want) > 20
        kept = D.drop(make(rows), bench, block_chars=block)
        assert kept.columns == make(rows).columns
        assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in rows if i not in {w[0] for w in want})


def test_pieces_and_windows():
    for n in (1, 3, 10, 55):
        for errors in range(8):
            cut = D.pieces("q" * n, errors)
            assert "".join(p for _, p in cut) == "q" * n and len(cut) == min(n, errors + 1) and all(p for _, p in cut)
    assert list(D.windows([1, 2, 9, 10, 30], 5)) == [(1, 2), (9, 10), (30, 30)]


def test_empty(spark, make, texts):
    bench = spark.createDataFrame([(1, "some benchmark passage")], "item_id long, text string")
    assert D.find(make([]), bench).count() == 0 and D.find(make(texts), bench.limit(0)).count() == 0
    assert D.drop(make(texts), bench.limit(0)).count() == len(texts) == D.drop(make(texts), bench).count()


def test_item_ids_of_other_types(spark):
    docs = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog again")], "doc_id int, text string")
    for kind, one in (("int", 7), ("string", "seven"), ("smallint", 7)):
        items = spark.createDataFrame([(one, "quick brown fox jumps over the lazy")], f"item_id {kind}, text string")
        got = D.find(docs, items).collect()
        assert [(r.doc_id, r.item_id) for r in got] == [(1, one)]
        assert D.drop(docs, items).count() == 0

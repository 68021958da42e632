from itertools import combinations

import pytest

from panelcast.llm import op13_urls as U


def pages(spark, urls):
    rows = [(None if u is None else i, u) for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' AS host", "'x' AS rule", "1 AS row", "'x' AS token", "'x' AS verdict")


def parts(url):
    if url is None or "://" not in url:
        return "", "", []
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "?#" if c in rest), default=len(rest))
    whole, after = rest[:end], rest[end:]
    host, slash, path = whole.partition("/")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    query = after[1:].split("#")[0] if after.startswith("?") else ""
    tokens = ["h:" + x for x in host.split(".") if x] + ["p:" + x for x in path.split("/") if x]
    tokens += ["q:" + x.split("=")[0] for x in query.split("&") if x.split("=")[0]]
    return host, slash + path, list(dict.fromkeys(tokens))


def by_list(host, path):
    fit = [(h + p, v) for h, p, v in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit, key=lambda r: len(r[0]), default=(None, None))


def brute_rules(labelled, min_support, min_confidence):
    """All token sets of all rows, counted."""
    count, with_label = {}, {}
    for tokens, verdict in labelled:
        for k in range(1, len(tokens) + 1):
            for c in combinations(sorted(tokens), k):
                count[c] = count.get(c, 0) + 1
                with_label[c, verdict] = with_label.get((c, verdict), 0) + 1
    n = len(labelled)
    rules = {(c, v): (k / count[c], k / n) for (c, v), k in with_label.items() if k / n >= min_support and k / count[c] >= min_confidence}
    return {(c, v): r for (c, v), r in rules.items()
            if not any((s, v) in rules and rules[s, v][0] >= r[0] for s in combinations(c, len(c) - 1) if s)}


URLS = [f"http{'s' * (i % 2)}://{('www.', 'm.', '')[i % 3]}h{i % 7}.example.{('com', 'net', 'org')[i % 5 % 3]}/{('en', 'de', 'fr', 'es')[i % 11 % 4]}/{i}{('', '?page=2&ref=x', '#top')[i % 4 % 3]}" for i in range(240)]


@pytest.mark.parametrize("support,confidence", [(0.04, 0.8), (0.1, 0.6), (0.3, 1.0)])
def test_rules_and_verdicts_by_brute_force(spark, support, confidence):
    df = pages(spark, URLS)
    split = [parts(u) for u in URLS]
    labelled = [(t, by_list(h, p)[1]) for h, p, t in split if by_list(h, p)[1]]
    # FP-growth takes a support of whole rows, rounded up
    want = brute_rules(labelled, support, confidence)
    rules = U.learn(df, min_support=support, min_confidence=confidence)
    got = {(tuple(r.antecedent), r.verdict): (r.confidence, r.support) for r in rules.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    for r in U.judge(df, rules).collect():
        host, path, tokens = split[r.page_id]
        rule, verdict = by_list(host, path)
        mined = [(c, s, -len(a), v == "block", v) for (a, v), (c, s) in want.items() if set(a) <= set(tokens)]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or (max(mined)[4] if mined else "allow"))


def test_awkward_urls(spark):
    urls = [None, "", "no scheme", "://", "http://", "HTTP://A.NET", "http://a.net/", "http://net/x", "http://xnet/x", "http://Éa.NET/en/ü?Q=1#f", "x://y://z.net/",
            "http://example.net/en", "http://example.net/en/", "http://b.example.net/en/1?a://b", "http://a.net?x/", "http://a.net#/", "http://user@a.org:80/fr/", "http://a.org/fr/",
            "http://a.com/" + "seg/" * 5000, "http://h\nost.net/p\nath", "http://a.net/"]
    got = U.judge(pages(spark, urls), U.learn(pages(spark, urls))).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path, _ = parts(urls[r.page_id] if r.page_id is not None else None)
        rule, verdict = by_list(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict)
    assert [r.verdict for r in got if r.page_id is None] == ["allow"]


def test_bounded_learning(spark):
    df = pages(spark, URLS * 3)
    few = U.learn(df, sample=200, width=2)
    assert 0 < few.count() and max(len(r.antecedent) for r in few.collect()) <= 2


def test_without_labels_and_empty(spark):
    df = pages(spark, ["http://a.com/en/1", "http://b.com/x"])
    rules = U.learn(df)
    assert rules.count() == 0 and {r.verdict for r in U.judge(df, rules).collect()} == {"allow"}
    none = df.limit(0)
    assert U.judge(none, U.learn(none)).count() == 0

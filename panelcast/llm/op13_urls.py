"""URL filter: listed rules first, association rules mined by FP-growth for the rest.

Listed rules are a host and a path; a rule fits its host and all subdomains where
the path of the url starts with the rule's, and the longest fitting rule decides.

All other urls go by mined rules. A labelled url is a transaction: its tokens
(host labels, path segments, names of query parameters) and its verdict. Spark's
FP-growth finds the frequent combinations; kept are the rules that lead from
tokens to a verdict with ``MIN_SUPPORT`` and ``MIN_CONFIDENCE``, less those that a
rule of one token fewer makes superfluous (same verdict, no less confidence).
An inverted index lists each rule under its rarest token, so a url meets only
rules of which it holds a token; of the rules whose tokens it all holds, the most
confident decides (then the better supported, the shorter, block before allow).
In the query, the urls that a listed rule covers are the labels.

Mining takes ``SAMPLE`` labelled rows at most (about, by a hash of the url), and of
each the ``WIDTH`` most frequent tokens, so a row has at most 2^WIDTH combinations;
judging reads all urls and all tokens.

Defined results: a null url, or one without ``://``, has an empty host and path, no
tokens and the default verdict (allow), as has any url that no mined rule fits;
repeated rows are judged each; without labels nothing is mined; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import store

#: The listed rules: host, path, verdict.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
MIN_SUPPORT, MIN_CONFIDENCE = 0.005, 0.8
SAMPLE, WIDTH = 500_000, 16
DEFAULT = "allow"
#: Marks a verdict among the items of a transaction; no token starts with it.
VERDICT = "="

MINED = "antecedent array<string>, verdict string, confidence double, support double"


def _rest(url: Column) -> Column:
    """What stands after the first ``://``; empty without it."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise("")


def split_url(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path`` and ``tokens``."""
    rest = F.coalesce(_rest(F.col(url)), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)

    def marked(mark, text, pattern, group=0):
        return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda x: F.concat(F.lit(mark), x))

    tokens = F.array_distinct(F.concat(
        marked("h:", F.col("host"), r"[^.]+"), marked("p:", F.col("path"), r"[^/]+"), marked("q:", query, r"(?:^|&)([^=&]+)", 1)))
    return pages.withColumns({"host": host, "path": path}).withColumn("tokens", tokens)


def listed(host: Column, path: Column, rules=RULES) -> Column:
    """Struct of ``rule`` and ``verdict`` of the longest fitting rule; null without one."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, sample: int = SAMPLE, width: int = WIDTH) -> DataFrame:
    """Rules (``MINED``) from ``tokens`` and ``verdict`` of labelled urls, pruned; stored."""
    from pyspark.ml.fpm import FPGrowth

    spark = labelled.sparkSession
    rows = labelled.select("tokens", "verdict", F.concat_ws("\n", "tokens").alias("line")).where(F.col("verdict").isNotNull())
    n = rows.count()
    if not n:
        return spark.createDataFrame([], MINED)
    if n > sample:
        rows = rows.where(F.pmod(F.xxhash64("line"), F.lit(1 << 20)) < int(sample / n * (1 << 20)))
    rows = store(rows.select(F.monotonically_increasing_id().alias("row"), "tokens", F.concat(F.lit(VERDICT), "verdict").alias("goal")), "url-labelled")
    least = min_support * rows.count()
    each = rows.select("row", "goal", F.explode("tokens").alias("token"))
    often = each.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    first = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "token"))), 1, width)["token"]
    short = each.join(often, "token").groupBy("row", "goal").agg(first.alias("tokens"))
    # a row without a frequent token still counts in every share
    bare = rows.select("row", "goal").join(short.select("row"), "row", "left_anti").select("row", "goal", F.array().cast("array<string>").alias("tokens"))
    items = short.unionByName(bare).select(F.concat("tokens", F.array("goal")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    found = model.associationRules.where(F.col("consequent")[0].startswith(VERDICT))
    found = store(found.select(
        F.sort_array("antecedent").alias("antecedent"), F.substring(F.col("consequent")[0], len(VERDICT) + 1, 1 << 20).alias("verdict"), "confidence", "support"), "url-rules")
    # superfluous: without one of its tokens the rule is as good
    shorter = found.select(F.col("antecedent").alias("__a"), F.col("verdict").alias("__v"), F.col("confidence").alias("__c"))
    less = found.where(F.size("antecedent") > 1).select("*", F.explode("antecedent").alias("__out"))
    less = less.select("antecedent", "verdict", "confidence", F.filter("antecedent", lambda x: x != F.col("__out")).alias("__less"))
    less = less.join(shorter, (F.col("__less") == F.col("__a")) & (F.col("verdict") == F.col("__v")) & (F.col("__c") >= F.col("confidence")), "left_semi")
    kept = found.join(less.select("antecedent", "verdict").distinct(), ["antecedent", "verdict"], "left_anti")
    return store(kept.select("antecedent", "verdict", "confidence", "support"), "url-kept")


def index(rules: DataFrame) -> DataFrame:
    """Inverted index: the rules under their rarest token (by the support of the rules that name it), as one list a token."""
    each = rules.select("*", F.explode("antecedent").alias("token"))
    common = each.groupBy("token").agg(F.max("support").alias("common"))
    rarest = each.join(common, "token").groupBy("antecedent", "verdict", "confidence", "support").agg(F.min(F.struct("common", "token"))["token"].alias("token"))
    rule = F.struct(
        "confidence", "support", (-F.size("antecedent")).alias("short"), (F.col("verdict") == "block").cast("int").alias("strict"),
        "verdict", F.concat_ws(" ", "antecedent").alias("mined"), "antecedent")
    return rarest.groupBy("token").agg(F.sort_array(F.collect_list(rule), asc=False).alias("rules"))


def judge(pages: DataFrame, rules: DataFrame, fixed=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, mined, confidence`` of every url, by the listed rules or the mined ones."""
    rows = split_url(pages.select("page_id", "url")).withColumn("__listed", listed(F.col("host"), F.col("path"), fixed))
    rows = rows.select("page_id", "host", "path", "tokens", F.col("__listed.rule").alias("rule"), F.col("__listed.verdict").alias("sure"))
    done = rows.where("sure IS NOT NULL").select("page_id", "host", "path", "rule", F.col("sure").alias("verdict"),
                                                  F.lit(None).cast("string").alias("mined"), F.lit(None).cast("double").alias("confidence"))
    rest = rows.where("sure IS NULL").select(F.monotonically_increasing_id().alias("row"), "page_id", "host", "path", "tokens")
    met = rest.select("*", F.explode_outer("tokens").alias("token")).join(index(rules), "token", "left")
    fits = F.filter("rules", lambda r: F.forall(r["antecedent"], lambda t: F.array_contains("tokens", t)))
    best = met.groupBy("row", "page_id", "host", "path").agg(F.max(F.get(fits, F.lit(0))).alias("best"))
    rest = best.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.coalesce("best.verdict", F.lit(DEFAULT)).alias("verdict"),
                       "best.mined", "best.confidence")
    return done.unionByName(rest)


def learn(pages: DataFrame, fixed=RULES, **kw) -> DataFrame:
    """Rules mined from the urls that a listed rule covers, with that rule's verdict as label."""
    rows = split_url(pages.select("url"))
    return mine(rows.select("tokens", listed(F.col("host"), F.col("path"), fixed)["verdict"].alias("verdict")), **kw)

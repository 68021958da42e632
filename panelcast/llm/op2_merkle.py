"""Document fingerprints: a Merkle tree over word runs, paragraphs and sections (DataFrame functions only).

Levels, from below: word runs, the leaves, each the SHA-256 of its text; paragraphs
(the text between line feeds), each the SHA-256 of its runs' digests; sections, each
the SHA-256 of its paragraphs' digests; the root, the SHA-256 of the sections'
digests. Borders are cut by content, not by position: a run ends after a word (text
between spaces) whose MD5 starts with a digit below 4 (one word in four), a section
after a paragraph whose digest starts with ``0`` (one in sixteen). What is put in or
taken out moves the borders next to it only.

Roots are equal exactly when texts are (SHA-256 apart). Likeness is read from the
leaves: twice the distinct leaves in common over the distinct leaves of both, 1 for
equal texts; the leaf of an empty paragraph is not counted. ``changed`` descends from
roots that differ to the sections that have no partner and to the paragraphs below those.

Defined results: a null text is empty; the empty text is one empty paragraph of one
empty run, with likeness 0 to any other text; repeated rows are each other's neighbours
(rows of one id are ordered by text); rows with a null id come last in descending order; a table of
one row is its own next; an empty table gives no rows; other columns are ignored.
Ids are numbers (or null): their quantiles deal the rows out. ``changed`` compares the
versions of one id: ids that repeat in a version, or are null, have no place in it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import text_frame
from panelcast.llm.neighbours import with_next

#: A word whose MD5 (hex) is below this ends a run.
CUT_BELOW = "4"
EMPTY = hashlib.sha256(b"").hexdigest()


def digest(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def word_runs(paragraph: Column) -> Column:
    """The runs of a paragraph, in order; joined by spaces they are the paragraph."""
    words = F.transform(F.split(paragraph, " ", -1), lambda w: F.when(F.md5(w) < CUT_BELOW, F.concat(w, F.lit("\n"))).otherwise(w))
    return F.split(F.rtrim(F.array_join(words, " "), F.lit("\n")), "\n ", -1)


def tree(text: Column) -> Column:
    """Struct of ``runs`` (digests, a list per paragraph), ``paragraphs`` and ``sections`` (digests in order) and the ``root``."""
    runs = F.transform(F.split(text, "\n", -1), lambda p: F.transform(word_runs(p), digest))

    def above(r: Column) -> Column:
        return _let(F.transform(r, lambda x: digest(F.array_join(x, " "))), lambda p: _let(
            F.transform(F.split(F.array_join(p, " "), "(?<=(?:^| )0[0-9a-f]{63}) ", -1), digest),
            lambda s: F.struct(r.alias("runs"), p.alias("paragraphs"), s.alias("sections"), digest(F.array_join(s, " ")).alias("root")),
        ))

    return _let(runs, above)


def root(text: Column) -> Column:
    return tree(text)["root"]


def mark(text: Column) -> Column:
    """Struct of the tree's root (``print``) and its distinct leaves (``leaves``, a 64-bit hash of each digest)."""
    return _let(tree(text), lambda t: F.struct(
        t["root"].alias("print"),
        F.array_distinct(F.transform(F.array_remove(F.flatten(t["runs"]), EMPTY), lambda r: F.xxhash64(r))).alias("leaves"),
    ))


def likeness(a: Column, b: Column) -> Column:
    """Of two marks."""
    total = F.size(a["leaves"]) + F.size(b["leaves"])
    shared = F.when(total == 0, F.lit(0.0)).otherwise(2.0 * F.size(F.array_intersect(a["leaves"], b["leaves"])) / total)
    return F.when(a["print"] == b["print"], F.lit(1.0)).otherwise(shared)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the tree of each text."""
    return text_frame(docs, id_col, text_col).select("doc_id", F.inline(F.array(tree(F.col("text")))))


def _matched(nodes: DataFrame) -> DataFrame:
    """``doc_id, side, at`` of the nodes of two versions (``doc_id, side, at, d``) that have no partner, or one out of order.

    The k-th node of a digest in one version is the partner of the k-th in the other; a pair is
    out of order when a pair that comes earlier in version a stands later in version b.
    """
    k = F.row_number().over(Window.partitionBy("doc_id", "side", "d").orderBy("at"))
    pairs = nodes.withColumn("k", k).groupBy("doc_id", "d", "k").agg(
        F.max(F.when(F.col("side") == "a", F.col("at"))).alias("a"), F.max(F.when(F.col("side") == "b", F.col("at"))).alias("b"),
    )
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    before = Window.partitionBy("doc_id", both).orderBy("a").rowsBetween(Window.unboundedPreceding, -1)
    late = pairs.withColumn("moved", F.coalesce(both & (F.max("b").over(before) > F.col("b")), F.lit(False))).where(~both | F.col("moved"))
    sides = F.array(*(F.struct(F.lit(s).alias("side"), F.col(s).alias("at")) for s in ("a", "b")))
    return late.select("doc_id", F.inline(sides)).where("at IS NOT NULL")


def changed(a: DataFrame, b: DataFrame) -> DataFrame:
    """Where two versions of a table of trees differ: per common ``doc_id`` whether they are ``equal``, the positions of
    sections that have no partner or have moved, and, below those only, the positions of such paragraphs, in each version."""
    trees = a.select("doc_id", F.lit("a").alias("side"), "sections", "paragraphs", "root").unionByName(
        b.select("doc_id", F.lit("b").alias("side"), "sections", "paragraphs", "root")
    )
    roots = a.select("doc_id", F.col("root").alias("ra")).join(b.select("doc_id", F.col("root").alias("rb")), "doc_id")
    judged = roots.select("doc_id", (F.col("ra") == F.col("rb")).alias("equal"))
    unlike = trees.join(judged.where("NOT equal"), "doc_id", "left_semi")
    sections = _matched(unlike.select("doc_id", "side", F.posexplode("sections").alias("at", "d")))
    line = Window.partitionBy("doc_id", "side").orderBy("at")
    ends = F.sum((F.col("d").startswith("0")).cast("int")).over(line.rowsBetween(Window.unboundedPreceding, -1))
    below = unlike.select("doc_id", "side", F.posexplode("paragraphs").alias("at", "d")).withColumn("section", F.coalesce(ends, F.lit(0)))
    open_ = sections.select("doc_id", "side", F.col("at").cast("long").alias("section"))
    paragraphs = _matched(below.join(open_, ["doc_id", "side", "section"], "left_semi").select("doc_id", "side", "at", "d"))
    out = judged
    for level, found in (("sections", sections), ("paragraphs", paragraphs)):
        places = found.groupBy("doc_id").agg(*(
            F.sort_array(F.collect_list(F.when(F.col("side") == s, F.col("at")))).alias(f"{level}_{s}") for s in ("a", "b")
        ))
        out = out.join(places, "doc_id", "left")
    none = F.array().cast("array<int>")
    return out.select("doc_id", "equal", *(F.coalesce(F.col(c), none).alias(c) for c in ("sections_a", "sections_b", "paragraphs_a", "paragraphs_b")))


def edited_pairs(docs: DataFrame, **how) -> DataFrame:
    """The contract's rows: every text, its edited text and the next document's, fingerprinted and compared."""
    rows = text_frame(docs)
    text = F.col("text")
    paired = with_next(rows, "doc_id", ["text"], {"n": F.length(text), "whole": text, "mark": mark(text)}, **how)
    half = F.floor(F.col("n") / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.col("n") - half), F.substr(F.col("next.whole"), F.lit(1), half))
    made = paired.withColumn("edited", edited).select("doc_id", "n", "mark", "next", digest(F.col("edited")).alias("edited_sha256"), mark(F.col("edited")).alias("edited"))
    return made.select(
        "doc_id", F.col("n").cast("long").alias("n_chars"), "edited_sha256",
        F.col("mark.print").alias("fingerprint"), F.col("edited.print").alias("edited_fingerprint"),
        likeness(F.col("mark"), F.col("edited")).alias("near_edited"),
        likeness(F.col("mark"), F.col("next.mark")).alias("near_next"),
    )


def _sql_runs(text: str) -> str:
    words = f"list_transform(string_split(p, ' '), lambda w: CASE WHEN md5(w) < '{CUT_BELOW}' THEN w || chr(10) ELSE w END)"
    runs = f"string_split(rtrim(array_to_string({words}, ' '), chr(10)), chr(10) || ' ')"
    return f"list_transform(string_split({text}, chr(10)), lambda p: list_transform({runs}, lambda r: sha256(r)))"


def _sql_root(runs: str) -> str:
    paragraphs = f"array_to_string(list_transform({runs}, lambda p: sha256(array_to_string(p, ' '))), ' ')"
    section = "(?:[1-9a-f][0-9a-f]{63} )*(?:0[0-9a-f]{63}|[1-9a-f][0-9a-f]{63}$)"
    return f"sha256(array_to_string(list_transform(regexp_extract_all({paragraphs}, '{section}'), lambda s: sha256(s)), ' '))"


def _sql_leaves(runs: str) -> str:
    return f"list_distinct(list_filter(flatten({runs}), lambda r: r <> '{EMPTY}'))"


def _sql_like(root_a: str, a: str, root_b: str, b: str) -> str:
    return (f"CASE WHEN {root_a} = {root_b} THEN 1.0::DOUBLE WHEN len({a}) + len({b}) = 0 THEN 0.0::DOUBLE "
            f"ELSE (2.0::DOUBLE * len(list_intersect({a}, {b}))) / (len({a}) + len({b})) END")


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
p AS (
  SELECT doc_id, text, length(text) AS n,
    coalesce(lead(text) OVER (ORDER BY doc_id DESC NULLS LAST, text), first_value(text) OVER (ORDER BY doc_id DESC NULLS LAST, text)) AS nxt
  FROM d
), e AS (SELECT *, substr(text, 1, n - n // 2) || substr(nxt, 1, n // 2) AS edited FROM p),
r AS (
  SELECT doc_id, n, sha256(edited) AS edited_sha256,
    {_sql_runs('text')} AS x, {_sql_runs('edited')} AS y, {_sql_runs('nxt')} AS z
  FROM e
), f AS (
  SELECT doc_id, n, edited_sha256,
    {_sql_root('x')} AS ra, {_sql_root('y')} AS rb, {_sql_root('z')} AS rc,
    {_sql_leaves('x')} AS a, {_sql_leaves('y')} AS b, {_sql_leaves('z')} AS c
  FROM r
)
SELECT doc_id, n::BIGINT AS n_chars, edited_sha256, ra AS fingerprint, rb AS edited_fingerprint,
  {_sql_like('ra', 'a', 'rb', 'b')} AS near_edited, {_sql_like('ra', 'a', 'rc', 'c')} AS near_next
FROM f
"""

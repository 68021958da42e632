"""Merkle dataset manifest with proofs by pointer jumping (DataFrame functions only).

A row's leaf is the SHA-256 (lowercase hex) of its fields. Per language the
leaves stand by id; every ``FANOUT`` consecutive nodes become one node of the
next level, the digest of their hex digests, until one is left, the subroot.
The subroots, ordered by language, grow the upper tree to the root in the same
way. A subroot and its leaf of the upper tree are one node.

Proofs: every node holds a pointer to an ancestor, at first its parent, and the
segment of siblings on the way there. A join of the nodes with themselves on the
pointer doubles its distance and puts the ancestor's segment behind the node's;
after log2(height) joins every leaf's segment leads to the root. A node has at
most ``FANOUT ** d`` nodes at distance ``d`` below it; from distance 4 on, the
ancestor stands in the join ``FANOUT ** (d / 2)`` times, each copy for its share
of them, so no join key is hot however large a language is.

Places are found without a task that holds a language: leaves are dealt out by
ranges of (language, id, leaf, row number) and counted per range.

Defined results: a null field is ``-``; a null id is never tampered with and
stands first; rows of one language and id stand by leaf, equal rows in any order
(they have equal leaves, but a proof each); one leaf alone is its own subroot, one
language alone makes its subroot the root (their proofs may be empty: the digest
of nothing); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import store

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER = -1


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _hex(digests: Column) -> Column:
    """The hex texts of an array of digests, behind one another."""
    return F.lower(F.concat_ws("", F.transform(digests, F.hex)))


def leaf_digest(**changed: Column) -> Column:
    """Digest of a row's fields, those given by name in place of the row's own."""
    parts = []
    for name in FIELDS:
        value = changed.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return _digest(F.concat(*parts))


def tampered_text() -> Column:
    return F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def hashed(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, leaf, tampered`` (digests of the row and of what tampering makes of it)."""
    hit = F.col("text").isNotNull() & (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 0)
    rows = docs.select(*FIELDS)
    rows = rows.select("doc_id", "lang", leaf_digest().alias("leaf"), F.when(hit, leaf_digest(text=tampered_text())).alias("tampered"))
    return rows.withColumn("tampered", F.coalesce("tampered", "leaf"))


def _in_ranges(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``rows`` dealt out by ranges of the keys, with the range's number ``part`` and the place ``pos`` in it."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.col("__at")
    line = rows.withColumn("__row", F.monotonically_increasing_id())
    line = line.repartitionByRange(parts, *keys, "__row").sortWithinPartitions(*keys, "__row")
    line = line.withColumn("__at", F.monotonically_increasing_id())
    line = line.select(*rows.columns, F.shiftright(at, 33).alias("part"), at.bitwiseAND((1 << 33) - 1).alias("pos"))
    return store(line, name)


def _places(line: DataFrame, group: str) -> DataFrame:
    """Per (range, ``group``): first place in the range, and rows of the group in earlier ranges; ranges + groups rows."""
    found = line.groupBy("part", group).agg(F.min("pos").alias("low"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return found.select("part", group, "low", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def leaves(docs: DataFrame) -> tuple[DataFrame, int, int]:
    """Level 0: ``t`` (number of the language), ``i`` (place in it), ``c`` (its leaves), digest, ``doc_id``, ``tampered``;
    and the number of languages and of leaves in the largest."""
    line = _in_ranges(store(hashed(docs), "manifest-hashed"), ["lang", "doc_id", "leaf"], "manifest-line")
    places = store(_places(line, "lang"), "manifest-places")
    sizes = places.groupBy("lang").agg(F.sum("n").alias("c"))
    langs, most = sizes.agg(F.count(F.lit(1)), F.max("c")).first()
    order = _in_ranges(sizes.withColumn("all", F.lit(0)), ["lang"], "manifest-langs")
    numbers = order.join(_places(order, "all"), ["part", "all"]).select(
        F.col("lang").alias("__lang"), "c", (F.col("pos") - F.col("low") + F.col("before")).alias("t"))
    seats = places.join(numbers, F.col("lang").eqNullSafe(F.col("__lang"))).select(
        F.col("part").alias("__part"), "__lang", "c", "t", (F.col("before") - F.col("low")).alias("shift"))
    met = line.join(seats, (F.col("part") == F.col("__part")) & F.col("lang").eqNullSafe(F.col("__lang")))
    return met.select("t", (F.col("pos") + F.col("shift")).alias("i"), "c", F.col("leaf").alias("digest"), "doc_id", "tampered"), langs, most or 0


def _grow(nodes: DataFrame, *carried: str) -> DataFrame:
    """The next level: trees with more than one node, ``FANOUT`` consecutive nodes to one that lists them as ``kids``."""
    kids = F.sort_array(F.collect_list(F.struct("i", "digest", *carried)))
    above = nodes.where("c > 1").groupBy("t", F.floor(F.col("i") / FANOUT).alias("i")).agg(
        F.ceil(F.first("c") / FANOUT).alias("c"), kids.alias("kids"))
    return above.withColumn("digest", _digest(_hex(F.col("kids.digest"))))


def _levels(nodes: DataFrame, most: int, name: str, *carried: str) -> list[DataFrame]:
    out = []
    while most > 1:
        out.append(store(_grow(nodes, *carried), f"{name}-{len(out) + 1}"))
        nodes, carried, most = out[-1].select("t", "i", "c", "digest"), (), -(-most // FANOUT)
    return out


def _children(level: DataFrame, above: int, langs: int, *carried: str) -> DataFrame:
    """The nodes below a level, each with its pointer (``pt, pl, pi``; null: the root) and the segment up to it."""
    top = F.col("c") == 1
    root = top & ((F.col("t") == UPPER) | F.lit(langs == 1))
    into_upper = top & (F.col("t") != UPPER)
    kid = level.select("*", F.posexplode("kids").alias("at", "kid"))
    others = F.filter(F.col("kids.digest"), lambda d, j: j != F.col("at"))
    return kid.select(
        F.col("t"), F.lit(above - 1).alias("l"), F.col("kid.i").alias("i"),
        F.when(~root, F.when(into_upper, F.lit(UPPER)).otherwise(F.col("t"))).cast("long").alias("pt"),
        F.when(~root, F.when(into_upper, F.lit(0)).otherwise(F.lit(above))).alias("pl"),
        F.when(~root, F.when(into_upper, F.col("t")).otherwise(F.col("i"))).alias("pi"),
        F.array(F.struct("at", others.alias("others"))).alias("segment"),
        F.when(into_upper, F.col("digest")).alias("sub"),
        *(F.col(f"kid.{c}").alias(c) for c in carried),
    )


def _jump(nodes: DataFrame, inner: DataFrame, distance: int) -> DataFrame:
    """``nodes`` with pointers twice as far: each takes over the pointer, and adds the segment, of the node it points to."""
    copies = FANOUT ** (distance // 2) if distance >= 4 else 1
    # only nodes with something at this distance below them; any node of the upper tree may have
    high = inner.where((F.col("l") >= distance) | (F.col("t") == UPPER)).select(
        F.col("t").alias("__t"), F.col("l").alias("__l"), F.col("i").alias("__i"), F.col("pt").alias("__pt"), F.col("pl").alias("__pl"),
        F.col("pi").alias("__pi"), F.col("segment").alias("__segment"), F.col("sub").alias("__sub"),
        F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("__copy"))
    share = F.pmod(F.xxhash64("t", "l", "i"), F.lit(copies)).cast("int")
    met = nodes.withColumn("__share", share).join(
        high, (F.col("pt") == F.col("__t")) & (F.col("pl") == F.col("__l")) & (F.col("pi") == F.col("__i")) & (F.col("__share") == F.col("__copy")), "left")
    moved = {"pt": "__pt", "pl": "__pl", "pi": "__pi"}
    return met.select(*(
        F.col(moved[c]).alias(c) if c in moved
        else F.when(F.col("__segment").isNull(), F.col(c)).otherwise(F.concat(c, "__segment")).alias(c) if c == "segment"
        else F.coalesce(c, "__sub").alias(c) if c == "sub"
        else F.col(c)
        for c in nodes.columns))


def proofs(docs: DataFrame) -> tuple[DataFrame, str | None]:
    """Every row's ``doc_id, leaf, tampered, sub`` (digests) and ``segment``, from its own run up to the root: its place
    ``at`` in the run and the ``others`` in it; and the root (hex, null for an empty table)."""
    line, langs, most = leaves(docs)
    base = store(line, "manifest-leaves")
    trees = _levels(base, most, "manifest-level", "doc_id", "tampered")
    subs = base.where("c = 1").select("t", "digest")
    for level in trees:
        subs = subs.unionByName(level.where("c = 1").select("t", "digest"))
    subs = store(subs, "manifest-subroots")
    upper = _levels(subs.select(F.lit(UPPER).cast("long").alias("t"), F.col("t").alias("i"), F.lit(langs).cast("long").alias("c"), "digest"), langs, "manifest-upper")
    root = None
    if langs:
        root = (upper[-1] if upper else subs).select(F.lower(F.hex("digest"))).first()[0]
    alone = F.lit(langs == 1)
    nodes = base.where("c = 1").select(
        "t", F.lit(0).alias("l"), "i",
        F.when(~alone, F.lit(UPPER)).cast("long").alias("pt"), F.when(~alone, F.lit(0)).alias("pl"), F.when(~alone, F.col("t")).alias("pi"),
        F.array().cast("array<struct<at:int,others:array<binary>>>").alias("segment"), F.col("digest").alias("sub"),
        "doc_id", "tampered", F.col("digest").alias("leaf"))
    if trees:
        first = _children(trees[0].select("t", "i", "c", "digest", "kids"), 1, langs, "doc_id", "tampered", "digest")
        nodes = nodes.unionByName(first.withColumnRenamed("digest", "leaf"))
    inner = None
    for above, level in [*enumerate(trees[1:], 2), *enumerate(upper, 1)]:
        more = _children(level, above, langs)
        inner = more if inner is None else inner.unionByName(more)
    distance, chain = 1, len(trees) + len(upper)
    while inner is not None and distance < chain:
        inner = store(inner, f"manifest-jump-{distance}")
        nodes = _jump(nodes, inner, distance)
        inner, distance = _jump(inner, inner, distance), distance * 2
    return nodes.select("doc_id", "leaf", "tampered", "sub", "segment"), root


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row."""
    rows, root = proofs(docs)

    def fold(below: Column, run: Column) -> Column:
        left, right = F.slice(run["others"], 1, run["at"]), F.slice(run["others"], run["at"] + 1, FANOUT)
        return F.sha2(F.concat(_hex(left), below, _hex(right)).cast("binary"), 256)

    text = F.lower(F.hex("leaf"))
    out = rows.select(
        "doc_id", text.alias("leaf"), F.lower(F.hex("sub")).alias("subroot"), F.lit(root).cast("string").alias("root"),
        F.sha2(_hex(F.flatten(F.col("segment.others"))).cast("binary"), 256).alias("proof_sha256"),
        F.aggregate("segment", F.lower(F.hex("tampered")), fold).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _oracle(levels: int = 7, upper: int = 3) -> str:
    """DuckDB twin for up to 8^levels leaves a language and 8^upper languages."""

    def h(x):
        return f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')"

    def grow(prefix, n):
        return [f"""{prefix}{k} AS (SELECT t, i // {FANOUT} AS i, (max(c) + {FANOUT - 1}) // {FANOUT} AS c, max(c) > 1 AS made,
            CASE WHEN max(c) > 1 THEN sha256(string_agg(d, '' ORDER BY i)) ELSE max(d) END AS d,
            CASE WHEN max(c) > 1 THEN list(d ORDER BY i) ELSE [] END AS kids FROM {prefix}{k - 1} GROUP BY t, i // {FANOUT})""" for k in range(1, n + 1)]

    def step(prefix, k, at, d):
        """Siblings and folded digest of one level."""
        p, kids = f"(({at} // {FANOUT ** (k - 1)}) % {FANOUT})", f"{prefix}{k}.kids"
        left = f"coalesce(array_to_string({kids}[1:{p}], ''), '')"
        right = f"coalesce(array_to_string({kids}[{p} + 2:], ''), '')"
        return f"CASE WHEN {prefix}{k}.made THEN {left} || {right} ELSE '' END", f"CASE WHEN {prefix}{k}.made THEN sha256({left} || {d} || {right}) ELSE {d} END"

    row = " || ".join(h(x) for x in FIELDS)
    bad = " || ".join(h("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')" if x == "text" else x) for x in FIELDS)
    ctes = [
        f"""crc AS (SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, {0xEDB88320} * (x & 1))) ORDER BY b) AS tab
            FROM (SELECT CAST(range AS BIGINT) AS b FROM range(256)))""",
        f"""n0 AS (SELECT dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS t, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, d) - 1 AS i,
            count(*) OVER (PARTITION BY lang) AS c, d, doc_id, CASE WHEN hit AND text IS NOT NULL THEN sha256({bad}) ELSE d END AS bad
            FROM (SELECT *, sha256({row}) AS d, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, strlen(CAST(doc_id AS VARCHAR)) + 1),
                lambda j: CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(j AS INT), 1)) AS BIGINT))),
                lambda x, y: xor(x >> 8, tab[CAST(xor(x & 255, y) AS INT) + 1])), 4294967295) % 3 = 0 AS hit FROM documents, crc))""",
        *grow("n", levels),
        f"u0 AS (SELECT 0 AS t, t AS i, count(*) OVER () AS c, d FROM n{levels})",
        *grow("u", upper),
    ]
    last = "a0"
    ctes.append("a0 AS (SELECT doc_id, d AS leaf, t, i, '' AS proof, bad AS fold FROM n0)")
    for prefix, n, key in (("n", levels, "i"), ("u", upper, "t")):
        for k in range(1, n + 1):
            sib, fold = step(prefix, k, f"a.{key}", "a.fold")
            tree = "a.t" if prefix == "n" else "0"
            ctes.append(f"""{prefix}a{k} AS (SELECT a.* REPLACE (a.proof || {sib} AS proof, {fold} AS fold)
                FROM {last} a JOIN {prefix}{k} ON {prefix}{k}.t = {tree} AND {prefix}{k}.i = a.{key} // {FANOUT ** k})""")
            last = f"{prefix}a{k}"
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, leaf, n{levels}.d AS subroot, u{upper}.d AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = u{upper}.d AS verified
FROM {last} a JOIN n{levels} ON n{levels}.t = a.t CROSS JOIN u{upper}"""


ORACLE = _oracle()

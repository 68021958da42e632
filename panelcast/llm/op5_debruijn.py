"""Repeated word windows by compacting a De Bruijn graph of the corpus.

A window of ``length`` words is an edge from the node of its first ``length - 1`` words
to that of its last ``length - 1``; an edge is repeated when its words start at more than
one place. Nodes with one repeated edge in and one out are passed through: the
nonbranching paths of repeated edges between all other nodes are compacted.

How it runs: a node belongs to one anchor, the smallest hash among the grams inside it
(see ``anchors``), so a run of consecutive nodes with one anchor, taken with the word
before and the word after it, ships all their edges in one row, and an anchor that
stands at one place only has no repeated edge. Equal runs are one class with a count.

* A class that is alone under its anchor is a nonbranching path already: each of its
  nodes has the edges of this class and no others.
* Classes that share an anchor become edge rows (node hashes, places), whose counts,
  in- and out-degrees come from Spark aggregations.
* An edge is named by the source coordinate of its first copy (id, text hash, word).
  Passed-through nodes link two edges: links to the next word of a text make segments
  (a window over each text's edges), the others join segments to paths, by self-joins
  that double the distance each round.

Each run is read again at its coordinates, in the text that is cut, and removed only if
its digest is that of its class. Edges of different classes are equal by two 64-bit hashes.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Windows are judged on the input.

Defined results: a null or empty text has no words; a text of fewer words than a
window keeps all; repeated rows repeat each other and lose all their windows;
rows with a null id count like any other; an empty table gives no rows; other
columns are ignored; a circle of edges is a path that starts at its first copy. Ids are
whole numbers (or null); ids of another type are an error of the cast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.anchors import runs, span_hashes
from panelcast.llm.common import store, utf8
from panelcast.llm.repeats import Text, Unit, _masks, given_id, keyed

LENGTH, GRAM = 35, 12
#: Bits of ``ends``: the run has a word before it, a word after it.
BEFORE, AFTER = 1, 2
#: Kinds of edge rows: between two nodes of the run, out of it, into it.
INNER, OUT, IN = 0, 1, 2
_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``store``, giving back the shuffle files of the job once its table is written."""
    conf = df.sparkSession.conf
    before = conf.get(_SETTING, None)
    conf.set(_SETTING, "true")
    try:
        return store(df, name)
    finally:
        conf.unset(_SETTING) if before is None else conf.set(_SETTING, before)


def _digest(text: Text, first: int, n: int, ends: int, nodes: Unit) -> bytes:
    """Digest of the words under ``n`` nodes from ``first`` on, with the words before and after."""
    a, b = first - (ends & BEFORE > 0), first + n + nodes.length - 2 + (ends & AFTER > 0)
    return xxhash.xxh3_128_digest(text.data[text.start(a) : text.end(b)], ends)


def _run_rows(raw: bytes, nodes: Unit) -> list[list]:
    """Rows (anchor hash, digest, first node, nodes, ends, times, further first nodes) of the distinct runs of a text."""
    text = Text(raw, nodes)
    if text.size <= nodes.length:
        return []
    hashes = text.grams(nodes)
    first, count, anchor = runs(hashes, nodes.width)
    seen: dict[bytes, list] = {}
    last = text.size - nodes.length  # the last node
    for h, f, n in zip(hashes[anchor].view(np.int64).tolist(), first.tolist(), count.tolist()):
        ends = (BEFORE if f else 0) | (AFTER if f + n <= last else 0)
        d = _digest(text, f, n, ends, nodes)
        if (row := seen.get(d)) is None:
            seen[d] = [h, d, f, n, ends, 1, None]
        else:
            row[5] += 1
            row[6] = (row[6] or b"") + f.to_bytes(4, "little")
    return list(seen.values())


def occurrences(docs: DataFrame, nodes: Unit) -> DataFrame:
    """One row per distinct run of each text: ``h, d1, d2, id, tk, first, n, ends, times, more``."""
    names = ["h", "d1", "d2", "id", "tk", "first", "n", "ends", "times", "more"]

    def run(batches):
        for batch in batches:
            ids, tks = batch.column("id").to_numpy(), batch.column("tk").to_numpy()
            at, data = utf8(batch.column("text"))
            own, rows = [], []

            def out():
                d = np.frombuffer(b"".join([r[1] for r in rows]), "<i8").reshape(-1, 2)
                i = np.array(own)
                return pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array(d[:, 0]), pa.array(d[:, 1]), pa.array(ids[i]), pa.array(tks[i]),
                     *(pa.array([r[k] for r in rows], pa.int32()) for k in (2, 3, 4, 5)), pa.array([r[6] for r in rows], pa.binary())],
                    names,
                )

            for k in range(batch.num_rows):
                got = _run_rows(data[at[k] : at[k + 1]].tobytes(), nodes)
                rows += got
                own += [k] * len(got)
                if len(rows) > 50_000:
                    yield out()
                    own, rows = [], []
            if rows:
                yield out()

    return docs.mapInArrow(run, "h long, d1 long, d2 long, id long, tk int, first int, n int, ends int, times int, more binary")


def _edge_rows(rows: DataFrame, classes: DataFrame, nodes: Unit) -> DataFrame:
    """The edges of each class, read at its first copy: ``u, v, kind, total, id, tk, pos, first``."""
    asked = classes.groupBy("id", "tk").agg(F.collect_list(F.struct("first", "n", "ends", "total")).alias("asked"))
    both = rows.join(asked, ["id", "tk"]).dropDuplicates(["id", "tk"]).select("id", "tk", "text", "asked")

    def run(batches):
        for batch in batches:
            at, data = utf8(batch.column("text"))
            lists = batch.column("asked")
            flat, cut = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            first, n, ends, total = (flat.field(k).to_numpy().astype(np.int64) for k in range(4))
            ids, tks = batch.column("id").to_numpy(), batch.column("tk").to_numpy()
            for k in range(batch.num_rows):
                text = Text(data[at[k] : at[k + 1]].tobytes(), nodes)
                count = text.size - nodes.length + 1
                node = span_hashes(np.frombuffer(text.data, np.uint8), text._starts[:count], text._ends[nodes.length - 1 :]).view(np.int64)
                s = slice(int(cut[k]), int(cut[k + 1]))
                before, after = (ends[s] & BEFORE) > 0, (ends[s] & AFTER) > 0
                a, b = first[s] - before, first[s] + n[s] - 1 + after  # edges [a, b)
                each = np.repeat(np.arange(len(a)), b - a)
                pos = np.arange(len(each)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + a[each]
                kind = np.where(pos < first[s][each], IN, np.where(pos == first[s][each] + n[s][each] - 1, OUT, INNER))
                m = len(each)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[pos]), pa.array(node[pos + 1]), pa.array(kind, pa.int32()), pa.array(total[s][each]), pa.array(np.full(m, ids[k])),
                     pa.array(np.full(m, tks[k], np.int32)), pa.array(pos, pa.int32()), pa.array(first[s][each], pa.int32())],
                    ["u", "v", "kind", "total", "id", "tk", "pos", "first"],
                )

    return both.mapInArrow(run, "u long, v long, kind int, total long, id long, tk int, pos int, first int")


def _place(prefix: str = "", pos: str = "pos") -> Column:
    return F.struct(*(F.col(prefix + c).alias(c) for c in ("id", "tk")), F.col(prefix + pos).alias("pos"))


class Graph:
    """Runs, classes and repeated edges of a corpus (tables in the checkpoint folder), and what is read from them."""

    def __init__(self, rows: DataFrame, length: int, gram: int):
        self.rows, self.edge, self.node = rows, Unit(True, length, gram), Unit(True, length - 1, gram)
        found = _stored(occurrences(rows, self.node), "runs")
        many = found.groupBy("h").agg(F.sum("times").alias("k")).where("k > 1").select("h")
        self.runs = _stored(found.join(many, "h", "left_semi"), "repeated-runs")
        classes = self.runs.groupBy("h", "d1", "d2").agg(
            F.sum("times").alias("total"), F.min(F.struct("id", "tk", "first")).alias("lead"), F.max("n").alias("n"), F.max("ends").alias("ends")
        ).select("h", "d1", "d2", "total", "lead.*", "n", "ends")
        size = classes.groupBy("h").agg((F.count("*") == 1).alias("alone"))
        self.classes = _stored(classes.join(size, "h"), "classes")
        shared = self.classes.where(~F.col("alone")).select("id", "tk", "first", "n", "ends", "total")
        self.met = _stored(_edge_rows(rows, shared, self.node), "edges")
        self.repeated = _stored(
            self.met.groupBy("kind", "u", "v").agg(F.sum("total").alias("copies"), F.min(_place()).alias("lead")).where("copies > 1"), "repeated-edges"
        )

    def links(self) -> DataFrame:
        """``a, b``: the first copies of the only edge into and the only edge out of each passed-through node of a shared anchor."""
        into = self.repeated.where(F.col("kind") != OUT).select(F.col("v").alias("node"), F.col("lead").alias("a"))
        out = self.repeated.where(F.col("kind") != IN).select(F.col("u").alias("node"), F.col("lead").alias("b"))
        return (
            into.unionByName(out, allowMissingColumns=True).groupBy("node")
            .agg(F.count("a").alias("ins"), F.count("b").alias("outs"), F.min("a").alias("a"), F.min("b").alias("b"))
            .where("ins = 1 AND outs = 1").select("a", "b")
        )

    def paths(self) -> DataFrame:
        """Segments of the compacted paths: ``path`` (place of its first segment), ``ordinal``, ``id, tk, pos``, ``m`` edges."""
        links = _stored(self.links(), "links")
        next_word = (F.col("a.id") == F.col("b.id")) & (F.col("a.tk") == F.col("b.tk")) & (F.col("a.pos") + 1 == F.col("b.pos"))
        alone = self.classes.where("alone").select(
            "id", "tk", F.col("first").alias("pos"), (F.col("n") - 1 + (F.col("ends").bitwiseAND(AFTER) > 0).cast("int")).alias("m"),
            (F.col("ends").bitwiseAND(BEFORE) > 0).alias("glued"),
        ).where("m > 0")
        single = self.repeated.where(F.col("kind") != IN).select("lead.*", F.lit(1).alias("m"), F.lit(False).alias("glued"))
        glue = links.where(next_word).select("b.*", F.lit(0).alias("m"), F.lit(True).alias("glued"))
        pieces = (
            alone.unionByName(single).unionByName(glue).repartition("id", "tk")
            .groupBy("id", "tk", "pos").agg(F.max("m").alias("m"), F.max("glued").alias("glued"))
        )
        in_text = Window.partitionBy("id", "tk").orderBy("pos")
        numbered = pieces.withColumn("k", F.sum((~F.col("glued")).cast("long")).over(in_text))
        segments = numbered.groupBy("id", "tk", "k").agg(F.min("pos").alias("pos"), F.sum("m").alias("m")).select(
            _place().alias("seg"), F.struct("id", "tk", (F.col("pos") + F.col("m") - 1).cast("int").alias("pos")).alias("last"), "m"
        )
        segments = _stored(segments, "segments")
        jumps = links.where(~next_word)
        prev = segments.select(F.col("last").alias("a"), F.col("seg").alias("prev")).join(jumps, "a").select(F.col("b").alias("seg"), "prev")
        chained = _stored(prev, "segment-links")
        head = _heads(chained)
        return segments.join(head, "seg", "left").select(
            F.coalesce("path", "seg").alias("path"), F.coalesce("ordinal", F.lit(0).cast("long")).alias("ordinal"), "seg.*", "m"
        )

    def marks(self, keep_first: bool) -> DataFrame:
        """Per text ``id, tk`` the ``runs`` to be cut: (first edge, edges, masks, further first edges, digest, ends, nodes)."""
        unit = self.edge
        own = self.repeated.where(F.col("kind") != IN).select("kind", "u", "v", "lead")
        met = self.met.where(F.col("kind") != IN).join(own, ["kind", "u", "v"])
        off = F.col("pos") - F.col("first")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(off, F.lit(64)).cast("int"))
        later = _place() > F.col("lead")

        def mask(k: int, use: Column) -> Column:
            return F.bit_or(F.when((F.floor(off / 64) == k) & use, bit).otherwise(F.lit(0).cast("long")))

        anys, prevs = _masks(unit, "any"), _masks(unit, "prev")
        shared = met.groupBy("id", "tk", "first").agg(
            *(mask(k, F.lit(True)).alias(c) for k, c in enumerate(anys)), *(mask(k, later).alias(c) for k, c in enumerate(prevs))
        )
        judged = self.classes.join(shared, ["id", "tk", "first"], "left").select(
            "h", "d1", "d2", F.struct("id", "tk", "first").alias("lead"), (F.col("alone") | (F.col("total") > 1)).alias("whole"), *anys, *prevs
        )
        at_lead = F.struct("id", "tk", "first") == F.col("lead")

        def made(k: int) -> Column:
            some = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
            if keep_first:
                return F.when(at_lead, some(prevs[k])).otherwise(F.lit(-1).cast("long"))
            return F.when(F.col("whole"), F.lit(-1).cast("long")).otherwise(some(anys[k]))

        edges = F.col("n") - 1 + (F.col("ends").bitwiseAND(AFTER) > 0).cast("int")
        run = F.struct("first", edges.alias("m"), *(made(k).alias(f"m{k}") for k in range(unit.longs)), "more", "d1", "ends", "n")
        some = " OR ".join([*(f"run.m{k} <> 0" for k in range(unit.longs)), "run.more IS NOT NULL"])
        return (
            self.runs.join(judged, ["h", "d1", "d2"]).select("id", "tk", run.alias("run")).where(f"run.m > 0 AND ({some})")
            .groupBy("id", "tk").agg(F.collect_set("run").alias("runs"))  # rows of equal id and text bring the same runs: each once
        )


def _heads(prev: DataFrame) -> DataFrame:
    """``seg, path, ordinal`` from ``seg, prev`` (one before and one after each at most): the distance doubles each round.
    Of a circle the smallest is the head."""
    if prev.isEmpty():
        return prev.select("seg", F.col("prev").alias("path"), F.lit(0).cast("long").alias("ordinal"))

    def doubled(step: DataFrame, circles: bool) -> tuple[DataFrame, DataFrame]:
        """Rows that reached a head, and those that run in circles with the smallest they met."""
        step = step.select("seg", "prev", F.lit(1).cast("long").alias("far"), F.least("seg", "prev").alias("least"))
        left, rounds = None, 0
        while True:
            ahead = step.select(F.col("seg").alias("prev"), F.col("prev").alias("p"), F.col("far").alias("f"), F.col("least").alias("l"))
            step = _stored(
                step.join(ahead, "prev", "left").select(
                    "seg", F.coalesce("p", "prev").alias("prev"), (F.col("far") + F.coalesce("f", F.lit(0))).alias("far"),
                    F.least("least", F.coalesce("l", "least")).alias("least"), F.col("p").isNotNull().alias("going"),
                ), "pointers",
            )
            rounds += 1
            now = step.where("going").count()
            if not now or now == left and 1 << rounds >= now:
                return step.where("NOT going"), step.where("going")
            left = now
            step = step.drop("going")

    straight, circling = doubled(prev, True)
    reached = straight.select("seg", F.col("prev").alias("path"), F.col("far").alias("ordinal"))
    if circling.isEmpty():
        return reached
    heads = circling.where(F.col("least") == F.col("seg")).select("seg")
    opened, _ = doubled(prev.join(circling.select("seg"), "seg", "left_semi").join(heads, "seg", "left_anti"), False)
    return reached.unionByName(opened.select("seg", F.col("prev").alias("path"), F.col("far").alias("ordinal")))


def _cover(batch: pa.RecordBatch, nodes: Unit, length: int):
    """A function from the number of a row and its ``Text`` to its covered words; each run is read again first."""
    col, later = batch.column("runs"), batch.column("copy").to_numpy() > 1
    flat, cut = col.flatten(), col.offsets.to_numpy()
    cut = cut - cut[0]
    longs = flat.type.num_fields - 6
    fields = [flat.field(k).to_pylist() for k in range(flat.type.num_fields)]
    valid = np.asarray(col.is_valid())

    def cover(k: int, text: Text) -> np.ndarray:
        if later[k]:
            return np.full(text.size, text.size >= length)
        edge = np.zeros(text.size + 1, np.int32)
        for i in range(int(cut[k]), int(cut[k + 1])) if valid[k] else ():
            first, m, *mask, more, d1, ends, n = (f[i] for f in fields)
            want = d1.to_bytes(8, "little", signed=True)
            for j, f in enumerate([first, *np.frombuffer(more, "<i4").tolist()] if more else [first]):
                if f + m - 1 + length > text.size or _digest(text, f, n, ends, nodes)[:8] != want:
                    continue
                if j or all(x == -1 for x in mask):  # a further copy in the same text is a later one
                    edge[f] += 1
                    edge[f + m - 1 + length] -= 1
                else:
                    for o in range(m):
                        if mask[o >> 6] >> (o & 63) & 1:
                            edge[f + o] += 1
                            edge[f + o + length] -= 1
        return np.cumsum(edge[:-1]) > 0

    assert longs >= 1
    return cover


def paths(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The compacted paths' segments at the source coordinates of their first copies: ``path`` (doc_id, text hash and word
    where it starts), ``ordinal``, ``doc_id`` (a negative hash of the text for rows without id), ``word``, ``n_words``."""
    found = Graph(keyed(docs), length, gram).paths()
    return found.select("path", "ordinal", F.col("id").alias("doc_id"), F.col("pos").alias("word"), (F.col("m") + length - 1).cast("long").alias("n_words"))


def cut(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep_first: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept, n_paths, longest``: each text's words without those under repeated windows; how
    many segments of compacted paths have their first copy there, and the words of the longest."""
    rows = keyed(docs)
    graph = Graph(rows, length, gram)
    here = graph.paths().groupBy("id", "tk").agg(F.count("*").alias("n_paths"), (F.max("m") + length - 1).cast("long").alias("longest"))
    told = graph.marks(keep_first).join(here, ["id", "tk"], "left")
    # before the join, whose exchange and order of the texts it shares; any order will do, as the texts are equal
    copy = F.row_number().over(Window.partitionBy("id", "tk").orderBy("tk")) if keep_first else F.lit(1)
    marked = rows.withColumn("copy", copy).join(told, ["id", "tk"], "left")
    nodes = graph.node

    def run(batches):
        for batch in batches:
            at, data = utf8(batch.column("text"))
            cover = _cover(batch, nodes, length)
            out = []
            for k in range(batch.num_rows):
                text = Text(data[at[k] : at[k + 1]].tobytes(), nodes)
                covered = cover(k, text)
                out.append((text.size, int(covered.sum()), text.kept(covered)))
            n, gone, kept = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()), batch.column("n_paths"), batch.column("longest")],
                ["id", "n_words", "n_removed", "kept", "n_paths", "longest"],
            )

    zero = F.lit(0).cast("long")
    made = marked.select(given_id(), "text", "runs", "copy", F.coalesce("n_paths", zero).alias("n_paths"), F.coalesce("longest", zero).alias("longest"))
    made = made.mapInArrow(run, "id long, n_words long, n_removed long, kept binary, n_paths long, longest long")
    return made.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept", "n_paths", "longest")


def digests(made: DataFrame) -> DataFrame:
    return made.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), "n_paths", "longest")

"""Ranked lexical search: exact inner products over sparse ball trees.

A document is a sparse vector of integer term impacts, an item a sparse vector of
term weights times repeats; the score is their inner product. Only terms of the
items at hand are dimensions, so vectors are exact and short.

The documents of a task form ball trees of a bounded number of rows: a node has a
centroid and the radius of its rows around it, and splits at the median between
two far rows; equal rows are one leaf, however many, that is scored once. No row below a node scores more than ``q.c + |q| r`` for an item
``q``; this bound is rounded up by more than its floating error. Nodes are opened
best-first by how far they may beat the items' tenth best score so far, and left
out for every item whose bound is below it. At a leaf, rows are scored exactly:
the factors are split into limbs whose products sum below 2^53. The best ten per
task and item are merged by a window. The tenth best score goes on from tree to
tree within a task.

Items are a stated query set: they are taken in blocks (``BLOCK_ITEMS`` items and
``BLOCK_TERMS`` terms, or one longer item), each block against all documents.
Corpus figures (N, L, document frequencies) are exact over all documents.

Defined results: a null or empty text has no terms; an item without terms, or
whose terms are in no document, has no rows; equal scores rank by ascending
``doc_id`` (null ids last); repeated documents and items stand for themselves; an
empty table gives no rows; other columns are ignored. Ids may be of any type that
can be ordered.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.llm.common import store, texts

TOP = 10
BLOCK_ITEMS, BLOCK_TERMS = 256, 50_000
#: Rows of a leaf; rows of a tree at most, and rows times dimensions of its dense block (64 MB).
LEAF, TREE_ROWS, TREE_CELLS = 64, 4096, 8 << 20
#: Relative surplus of a bound; the error of a sum of k nonnegative terms is below k * 2^-52 of it.
SURPLUS = 1e-7
#: Limbs of 20 bits, over at most 4096 dimensions at once: every partial sum stays below 2^53.
LIMB, SPAN = 20, 4096

#: Maps bytes that belong to no term to a space and A-Z to a-z; bytes over 127 only occur inside other letters.
_TERM = bytes((b + 32 if 65 <= b <= 90 else b) if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERM).split()


def item_blocks(items: DataFrame, most_items: int = BLOCK_ITEMS, most_terms: int = BLOCK_TERMS) -> Iterator[list[tuple[object, Counter]]]:
    """Items and their term counts, a bounded block at a time (rows are fetched partition by partition)."""
    block, size = [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        found = Counter(terms((row["text"] or "").encode()))
        if block and (len(block) == most_items or size + len(found) > most_terms):
            yield block
            block, size = [], 0
        block.append((row["item_id"], found))
        size += len(found)
    if block:
        yield block


def vectors(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """``doc_id``, its terms with repeats ``n``, the numbers of those in the vocabulary and how often each occurs; stored."""
    number = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})
    kind = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string("n long, term array<int>, tf array<int>").fields])

    def run(batches):
        known = number.value
        for batch in batches:
            n, at, term, tf = [], [0], [], []
            for text in texts(batch.column("text")):
                words = terms(text)
                held = Counter(words)
                n.append(len(words))
                for t in held.keys() & known.keys():
                    term.append(known[t])
                    tf.append(held[t])
                at.append(len(term))
            offsets = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(n, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(term, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(tf, pa.int32()))], ["doc_id", "n", "term", "tf"])

    return store(docs.select("doc_id", "text").mapInArrow(run, kind), "lexical-vectors")


def weights(block, number: dict[bytes, int], df: np.ndarray, n_docs: int) -> np.ndarray:
    """Terms x items: weight times repeats."""
    w = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    q = np.zeros((len(number), len(block)), np.int64)
    for j, (_, found) in enumerate(block):
        for t, k in found.items():
            q[number[t], j] = w[number[t]] * k
    return q


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    m = 25 + 75 * n * n_docs // n_terms
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def exact_scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Integer products of impacts (rows x terms, whole numbers below 2^20 as doubles) and weights (terms x items)."""
    out = np.zeros((len(x), q.shape[1]), np.int64)
    for a in range(0, x.shape[1], SPAN):
        part, rest, shift = x[:, a : a + SPAN], q[a : a + SPAN], 0
        while rest.any():
            limb = (rest & ((1 << LIMB) - 1)).astype(np.float64)
            out += (part @ limb).astype(np.int64) << shift
            rest, shift = rest >> LIMB, shift + LIMB
    return out


class BallTree:
    """Ball tree over the rows of a dense block: ``order`` of rows, and per node its range, children, centroid, radius,
    and whether its rows are all equal."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.x, self.leaf = x, leaf
        self.order = np.arange(len(x))
        self.ranges, self.children, self.centres, self.radii, self.equal = [], [], [], [], []
        if len(x):
            self._node(0, len(x))
        self.centres = np.array(self.centres).reshape(len(self.ranges), x.shape[1])
        self.radii = np.array(self.radii)

    def _node(self, a: int, b: int) -> int:
        me, rows = len(self.ranges), self.x[self.order[a:b]]
        centre = rows.mean(0)
        off = np.sqrt(((rows - centre) ** 2).sum(1))
        self.ranges.append((a, b))
        self.children.append(())
        self.centres.append(centre)
        self.radii.append(off.max())
        self.equal.append(bool((rows == rows[0]).all()))
        if b - a > self.leaf and not self.equal[me]:
            one = rows[off.argmax()]
            two = rows[((rows - one) ** 2).sum(1).argmax()]
            mid = (b - a) // 2
            self.order[a:b] = self.order[a:b][np.argsort(rows @ (two - one), kind="stable")]
            self.children[me] = (self._node(a, a + mid), self._node(a + mid, b))
        return me

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Nodes x items: no row of the node scores more."""
        length = np.sqrt((q * q).sum(0))
        return (self.centres @ q + self.radii[:, None] * length) * (1 + SURPLUS) + 1


class Best:
    """The best ``top`` rows of each item so far; of equal scores, those found first by ``place``."""

    def __init__(self, items: int, top: int = TOP):
        self.top, self.rows = top, [[] for _ in range(items)]  # heaps of (score, -rank of the id's order)
        self.least = np.ones(items)  # a score below this cannot enter

    def offer(self, item: int, score: int, place) -> None:
        heap = self.rows[item]
        entry = (score, place)
        if len(heap) < self.top:
            heapq.heappush(heap, entry)
        elif entry > heap[0]:
            heapq.heapreplace(heap, entry)
        if len(heap) == self.top:
            self.least[item] = max(1, heap[0][0])


class _Place:
    """Orders ids so that the greater place is the smaller id; null ids are the smallest places."""

    __slots__ = ("id",)

    def __init__(self, id_):
        self.id = id_

    def __lt__(self, other):
        if self.id is None or other.id is None:
            return self.id is None and other.id is not None
        return self.id > other.id

    def __eq__(self, other):
        return self.id == other.id


def search_tree(x: np.ndarray, ids: list, q: np.ndarray, best: Best, leaf: int = LEAF) -> int:
    """Offers the rows of one tree that may be among the best; returns the number of leaves scored."""
    tree = BallTree(x, leaf)
    if not len(x):
        return 0
    bound = tree.bounds(q.astype(np.float64))
    opened, queue = 0, [(-float((bound[0] - best.least).max()), 0)]
    while queue:
        _, node = heapq.heappop(queue)
        active = np.flatnonzero(bound[node] >= best.least)
        if not len(active):
            continue
        if tree.children[node]:
            for child in tree.children[node]:
                gain = float((bound[child] - best.least).max())
                if gain >= 0:
                    heapq.heappush(queue, (-gain, child))
            continue
        opened += 1
        rows = tree.order[slice(*tree.ranges[node])]
        if tree.equal[node]:
            # the smallest ids stand for their equals
            score = exact_scores(x[rows[:1]], q[:, active])[0]
            places = heapq.nlargest(best.top, (_Place(ids[r]) for r in rows))
            for j in np.flatnonzero(score >= best.least[active]):
                for place in places:
                    best.offer(int(active[j]), int(score[j]), place)
            continue
        scores = exact_scores(x[rows], q[:, active])
        for i, j in zip(*np.nonzero(scores >= best.least[active])):
            if scores[i, j] >= best.least[active[j]]:
                best.offer(int(active[j]), int(scores[i, j]), _Place(ids[rows[i]]))
    return opened


def search_block(docs: DataFrame, block, top: int = TOP, tree_rows: int = TREE_ROWS, leaf: int = LEAF) -> DataFrame:
    """The best of each task for every item of a block: ``item`` (its place in the block), ``doc_id``, ``score``."""
    spark = docs.sparkSession
    vocabulary = sorted(set().union(*(found for _, found in block)))
    held = vectors(docs, vocabulary)
    n_docs, n_terms = held.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    for term, k in held.select(F.explode("term").alias("term")).groupBy("term").count().collect():
        df[term] = k
    q = weights(block, {t: i for i, t in enumerate(vocabulary)}, df, n_docs)
    shared = spark.sparkContext.broadcast((q, n_docs, n_terms))
    id_field = docs.schema["doc_id"]

    def run(batches):
        q, n_docs, n_terms = shared.value
        best, id_type = Best(q.shape[1], top), None
        size = max(leaf, min(tree_rows, TREE_CELLS // max(1, len(q))))
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for a in range(0, batch.num_rows, size):
                part = batch.slice(a, size)
                ids, n = part.column("doc_id").to_pylist(), part.column("n").to_numpy()
                lists, tf = part.column("term"), part.column("tf").flatten().to_numpy().astype(np.int64)
                row = np.repeat(np.arange(len(ids)), pc.list_value_length(lists).to_numpy())
                used, column = np.unique(lists.flatten().to_numpy(), return_inverse=True)
                x = np.zeros((len(ids), len(used)))
                x[row, column] = impacts(tf, n[row], n_docs, n_terms)
                search_tree(x, ids, q[used], best, leaf)
        rows = [(j, place.id, score) for j, heap in enumerate(best.rows) for score, place in heap]
        if rows:
            item, doc, score = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc, id_type), pa.array(score, pa.int64())], ["item", "doc_id", "score"])

    kind = T.StructType([T.StructField("item", T.IntegerType()), id_field, T.StructField("score", T.LongType())])
    return held.where("size(term) > 0").mapInArrow(run, kind)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, **kw) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents of each item."""
    spark, out = docs.sparkSession, None
    id_field = T.StructField("item_id", items.schema["item_id"].dataType)
    line = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    for block in item_blocks(items):
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], T.StructType([T.StructField("place", T.IntegerType()), id_field]))
        found = search_block(docs, block, top, **kw).withColumn("rank", F.row_number().over(line)).where(F.col("rank") <= top)
        found = store(found.join(names, F.col("item") == F.col("place")).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"), "lexical-best")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], T.StructType([id_field, T.StructField("rank", T.IntegerType()), docs.schema["doc_id"], T.StructField("score", T.LongType())]))
    return out


ORACLE = r"""
WITH t AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
  whole AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM t WHERE len(terms) > 0),
  tf AS (SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(terms) AS term FROM t) GROUP BY r, term),
  df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
  w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) AS w FROM df, whole),
  q AS (SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
  qt AS (SELECT item, item_id, term, CAST(count(*) AS BIGINT) AS k FROM q GROUP BY item, item_id, term),
  m AS (SELECT doc_id, r, 25 + (75 * CAST(len(terms) AS BIGINT) * n_docs) // n_terms AS m FROM t, whole WHERE len(terms) > 0),
  s AS (SELECT item, item_id, r, CAST(sum(k * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
        FROM qt JOIN tf USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY item, item_id, r),
  ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM s JOIN m USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""

"""Benchmark decontamination by pigeonhole edit matching.

A text is contaminated by a test item when some stretch of it is within the
item's error budget, ``RATE`` of the item's length in edits (both lower-cased,
with white space as single spaces). An item is split into budget + 1 pieces; of
these at least one stands unchanged in such a stretch, so exact hits of all
pieces of all items (one Aho-Corasick automaton) propose every place, and Myers'
bit-parallel distance decides each. Hits of one item on nearby diagonals are
decided together.

The test items are the query set. They go to the tasks in blocks of a bounded
size (``BLOCK_CHARS``), one pass over the texts for each block; texts are never
shuffled and need no neighbours. The blocks are read while the plan is built, so
the driver holds the texts of the whole benchmark (items, not documents).

Defined results: items that are null or empty after normalising match nothing;
null and empty texts hold nothing; equal items each match; repeated rows are
searched each; an empty table on either side gives no rows; other columns are
ignored by ``find`` and kept by ``drop``.
"""

from __future__ import annotations

from itertools import groupby

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: Edits allowed per character of an item.
RATE = 0.08
#: Characters of test items that one pass looks for, about.
BLOCK_CHARS = 4_000_000


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def budget(item: str, rate: float = RATE) -> int:
    return int(len(item) * rate)


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece) of errors + 1 pieces of nearly equal length."""
    n = min(errors + 1, len(item))
    edges = [len(item) * k // n for k in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:])]


class Pattern:
    """Myers' bit vectors of one item: best distance of the item to any stretch of a text, and where that ends."""

    def __init__(self, item: str):
        self.item, self.size = item, len(item)
        self.bits: dict[str, int] = {}
        for i, c in enumerate(item):
            self.bits[c] = self.bits.get(c, 0) | 1 << i

    def best(self, text: str, free_start: bool = True) -> tuple[int, int]:
        """(distance, end) of the closest stretch, the earliest among equals."""
        full, top = (1 << self.size) - 1, 1 << (self.size - 1)
        up, down, score = full, 0, self.size
        found, bits = (score, 0), self.bits.get
        for at, c in enumerate(text, 1):
            eq = bits(c, 0)
            flat = eq | down
            cross = (((eq & up) + up) ^ up) | eq
            plus = down | (full & ~(cross | up))
            minus = up & cross
            if plus & top:
                score += 1
            elif minus & top:
                score -= 1
            plus = plus << 1 if free_start else plus << 1 | 1
            minus <<= 1
            up = (minus | ~(flat | plus)) & full
            down = plus & flat & full
            if score < found[0]:
                found = (score, at)
        return found


class Items:
    """Test items ready to be looked for."""

    def __init__(self, rows: list[tuple], rate: float = RATE):
        self.rows, self.rate = rows, rate
        self.ready = None

    def __getstate__(self):
        return self.rows, self.rate

    def __setstate__(self, state):
        self.__init__(*state)

    def build(self):
        automaton, spots = ahocorasick.Automaton(), {}
        patterns = []
        for number, (item_id, text) in enumerate(self.rows):
            item = normal(text)
            errors = budget(item, self.rate)
            patterns.append((item_id, item, errors, Pattern(item)))
            for offset, piece in pieces(item, errors) if item else ():
                spots.setdefault(piece, []).append((number, offset))
        for piece, where in spots.items():
            automaton.add_word(piece, (len(piece), where))
        if spots:
            automaton.make_automaton()
        self.ready = automaton, patterns, bool(spots)

    def find(self, text: str) -> list[tuple]:
        """(item_id, distance, start about, end) of the closest stretch of every item within budget, in the normalised text."""
        if self.ready is None:
            self.build()
        automaton, patterns, any_ = self.ready
        if not any_ or not text:
            return []
        text = normal(text)
        hits = sorted({(n, end + 1 - size - offset) for end, (size, where) in automaton.iter(text) for n, offset in where})
        out = []
        for n, mine in groupby(hits, key=lambda h: h[0]):
            item_id, item, errors, pattern = patterns[n]
            best = None
            for low, high in windows([d for _, d in mine], errors):
                a = max(0, low - errors)
                stretch = text[a : high + len(item) + errors]
                at = stretch.find(item)
                distance, end = (0, at + len(item)) if at >= 0 else pattern.best(stretch)
                if distance <= errors and (best is None or distance < best[0]):
                    best = distance, a + end
                if best and best[0] == 0:
                    break
            if best:
                out.append((item_id, best[0], max(0, best[1] - len(item)), best[1]))
        return out


def windows(diagonals: list[int], errors: int):
    """Ranges of the ascending diagonals whose neighbours are within the budget of each other."""
    low = high = diagonals[0]
    for d in diagonals[1:]:
        if d - high > errors:
            yield low, high
            low = d
        high = d
    yield low, high


def blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int):
    """The test items, a bounded block of them at a time."""
    items = benchmark.where(F.length(F.trim(text_col)) > 0).select(F.col(item_col).alias("item_id"), F.col(text_col).alias("text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-chars // block_chars)
    for k in range(n):
        yield [tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()]


def find(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of ``docs`` and item found in it: ``doc_id, item_id, distance, start, end`` (in the normalised text)."""
    spark = docs.sparkSession
    kinds = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, distance int, start long, end long"
    found = spark.createDataFrame([], schema)
    for rows in blocks(benchmark, "item_id", "text", block_chars):
        search = _search(spark.sparkContext.broadcast(Items(rows, rate)), to_arrow_type(benchmark.schema["item_id"].dataType))
        found = found.unionByName(docs.select("doc_id", "text").mapInArrow(search, schema))
    return found


def _search(shared, id_type: pa.DataType):
    def run(batches):
        items = shared.value
        for batch in batches:
            own, rows = [], []
            for k, text in enumerate(batch.column("text")):
                got = items.find(text.as_py() or "")
                rows += got
                own += [k] * len(got)
            if rows:
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(own)), pa.array(cols[0], id_type), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())],
                    ["doc_id", "item_id", "distance", "start", "end"],
                )

    return run


def drop(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that hold no test item."""
    spark = docs.sparkSession
    out = docs
    for rows in blocks(benchmark, "item_id", "text", block_chars):
        out = out.mapInArrow(_clean(spark.sparkContext.broadcast(Items(rows, rate)), docs.columns.index("text")), docs.schema)
    return out


def _clean(shared, at: int):
    def run(batches):
        items = shared.value
        for batch in batches:
            keep = [not items.find(text.as_py() or "") for text in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run

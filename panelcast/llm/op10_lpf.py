"""Repeated byte strings: digest counts, and longest-previous-factor arrays where they leave a question.

A position of a text may be cut when the ``LENGTH`` bytes from it also stand
earlier or, where all copies go, anywhere else. ``repeats`` drops every run whose
anchor is unique and settles runs that are equal as wholes by counting digests;
that decides most. Where different runs meet under one anchor, one stretch per
class is concatenated in order of first occurrence, a bounded block at a time, and
each block is put in suffix order (prefix doubling over ranks, ties in text order).
The previous and the next smaller position in that order are the two candidates for
the longest earlier match; the longer common prefix of the two is the entry of the
longest-previous-factor array (lengths are counted up to ``LENGTH``). A window whose
entry reaches ``LENGTH`` is a later copy. Where all copies go, the longest common
prefix with a neighbour in suffix order takes the entry's place. Groups of more than
``GROUP`` classes are counted by digests of their windows instead, with the same result.

Matches never cross texts; bytes are UTF-8; strings are judged on the input.

Defined results: a null or empty text has no bytes; a shorter text keeps all;
repeated rows repeat each other (with ``keep_first`` one of the rows equal in id
and text is the first, the others are later copies); rows with a null id count like any other
and come before ids from 0 on; an empty table gives no rows; other columns are kept by
``dedup``. Where ``dedup`` returns text, characters cut in part stay whole. Ids are
whole numbers (or null); ids of another type are an error of the cast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import utf8
from panelcast.llm.repeats import GROUP, Unit, covers, given_id, keyed, marked, row_key

#: With these an anchor has 128 windows at most: two longs of bits.
LENGTH, GRAM = 200, 73


def _dense(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense ranks of the keys, and their order."""
    order = np.argsort(keys)
    ranked = keys[order]
    out = np.empty(len(keys), np.uint64)
    out[order] = np.cumsum(np.concatenate([[0], ranked[1:] != ranked[:-1]])).astype(np.uint64)
    return out, order


def doubled_ranks(data: np.ndarray, length: int) -> list[tuple[int, np.ndarray]]:
    """Ranks of all suffixes of ``data`` by their first 8, 16, 32, ... and last ``length`` bytes, by prefix doubling (past the end counts as zeros)."""
    have = min(8, length)
    padded = np.concatenate([data, np.zeros(have, np.uint8)])
    keys = np.zeros(len(data), np.uint64)
    for k in range(have):
        keys = keys << np.uint64(8) | padded[k : k + len(data)]
    ranks, _ = _dense(keys)
    levels = [(have, ranks.astype(np.uint32))]
    while have < length:
        step = min(have, length - have)
        ahead = np.zeros(len(ranks), np.uint64)
        ahead[: max(0, len(ranks) - step)] = ranks[step:] + np.uint64(1)
        ranks, _ = _dense(ranks << np.uint64(32) | ahead)
        have += step
        levels.append((have, ranks.astype(np.uint32)))
    return levels


def suffix_ranks(data: np.ndarray, length: int) -> np.ndarray:
    """Rank of every suffix of ``data`` compared on its first ``length`` bytes."""
    return doubled_ranks(data, length)[-1][1]


def common_bytes(data: np.ndarray, levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of the suffixes at ``a`` and ``b``, up to the length the ranks go to (which both must have)."""
    length = levels[-1][0]
    got = np.zeros(len(a), np.int64)
    for have, ranks in reversed(levels):
        go = np.flatnonzero(got + have <= length)
        go = go[ranks[a[go] + got[go]] == ranks[b[go] + got[go]]]
        got[go] += have
    go = np.arange(len(a))
    for _ in range(levels[0][0] - 1):  # less than the first level is left
        go = go[got[go] < length]
        go = go[data[a[go] + got[go]] == data[b[go] + got[go]]]
        got[go] += 1
    return got


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """Per entry the place of the nearest entry before it with a smaller value, -1 without one (descent over minima of 2^k entries)."""
    minima = [values]  # minima[k][i]: least of the 2^k entries that end with the i-th
    while 1 << len(minima) <= len(values):
        step, last = 1 << (len(minima) - 1), minima[-1]
        wide = last.copy()
        wide[step:] = np.minimum(last[step:], last[:-step])
        minima.append(wide)
    at = np.arange(len(values)) - 1
    for k in range(len(minima) - 1, -1, -1):
        go = np.flatnonzero(at >= (1 << k) - 1)
        go = go[minima[k][at[go]] > values[go]]
        at[go] -= 1 << k
    return at


def previous_factors(data: np.ndarray, starts: np.ndarray, levels: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Per start (ascending positions) the length of its longest factor that starts at another start, and that of the longest
    that starts at an earlier one (the array of longest previous factors), both up to the length the ranks go to.

    In suffix order the earlier start with the longest common prefix is the nearest smaller position above or below; the start
    with the longest common prefix at all is a neighbour.
    """
    order = np.lexsort((starts, levels[-1][1][starts]))  # suffix order, ties in text order
    place = starts[order]
    beside = common_bytes(data, levels, place[:-1], place[1:])
    other = np.zeros(len(starts), np.int64)
    other[order[1:]] = beside
    other[order[:-1]] = np.maximum(other[order[:-1]], beside)
    earlier = np.zeros(len(starts), np.int64)
    n = len(place)
    for near in (previous_smaller(place), n - 1 - previous_smaller(place[::-1])[::-1]):
        has = np.flatnonzero((near >= 0) & (near < n))
        earlier[order[has]] = np.maximum(earlier[order[has]], common_bytes(data, levels, place[has], place[near[has]]))
    return other, earlier


def shared_factors(rows: list[tuple], unit: Unit):
    """Per stretch (class) which of its windows also lie in another stretch, and which in an earlier one: those whose
    longest (previous) factor has the length of a window."""
    n = np.array([r[3] for r in rows])
    size = np.array([len(r[4]) for r in rows])
    at = np.concatenate([[0], np.cumsum(size)[:-1]])
    data = np.frombuffer(b"".join([r[4] for r in rows]), np.uint8)
    edge = np.concatenate([[0], np.cumsum(n)])
    starts = np.repeat(at - edge[:-1], n) + np.arange(edge[-1])
    other, earlier = (x >= unit.length for x in previous_factors(data, starts, doubled_ranks(data, unit.length)))
    return [(r[:3], other[a:b], earlier[a:b]) for r, a, b in zip(rows, edge[:-1].tolist(), edge[1:].tolist())]


def spans(covered: np.ndarray) -> int:
    """Maximal runs of covered bytes."""
    return int(np.count_nonzero(np.diff(np.concatenate([[0], covered.view(np.int8)])) == 1))


def cut(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep_first: bool = False, group: int = GROUP) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept``: each text's bytes without those under repeated strings."""
    unit = Unit(False, length, gram)
    rows = marked(keyed(docs), unit, shared_factors, keep_first=keep_first, group=group)

    def run(batches):
        for batch in batches:
            at, data = utf8(batch.column("text"))
            cover = covers(batch, unit)
            out = []
            for k in range(batch.num_rows):
                raw = data[at[k] : at[k + 1]]
                covered = cover(k, len(raw))
                out.append((len(raw), int(covered.sum()), spans(covered), raw[~covered].tobytes()))
            n, gone, runs, kept = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(x, pa.int64()) for x in (n, gone, runs)), pa.array(kept, pa.binary())],
                ["id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    made = rows.select(given_id(), "text", "runs", "copy").mapInArrow(run, "id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return made.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")


def digests(made: DataFrame) -> DataFrame:
    return made.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def whole_characters(raw: np.ndarray, covered: np.ndarray) -> np.ndarray:
    """The covered bytes less those of characters that are covered in part."""
    lead = (raw & 0xC0) != 0x80
    char = np.cumsum(lead) - 1
    if not len(raw):
        return covered
    all_ = np.logical_and.reduceat(covered, np.flatnonzero(lead)) if lead[0] else covered
    return all_[char] if lead[0] else covered


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep_first: bool = True, group: int = GROUP) -> DataFrame:
    """The columns of ``docs``; ``text`` without repeated strings (by default the first copy of each stays) and
    ``n_chars``, where there is one, as its new length. A null text stays null."""
    unit = Unit(False, length, gram)
    names = docs.columns
    rest = [c for c in names if c not in ("text", "n_chars")]
    id_, tk, text_ = row_key(docs)
    rows = docs.select(
        id_.alias("id"), tk.alias("tk"), text_.alias("text"), F.col("text").isNull().alias("none"), F.struct(*rest).alias("rest"),
    )
    made = marked(rows, unit, shared_factors, keep_first=keep_first, group=group)

    def run(batches):
        for batch in batches:
            at, data = utf8(batch.column("text"))
            cover = covers(batch, unit)
            out = []
            for k in range(batch.num_rows):
                raw = data[at[k] : at[k + 1]]
                out.append(raw[~whole_characters(raw, cover(k, len(raw)))].tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column("rest"), batch.column("none"), pa.array(out, pa.string())], ["rest", "none", "text"])

    from pyspark.sql.types import BooleanType, StringType, StructField, StructType

    schema = StructType([StructField("rest", rows.schema["rest"].dataType), StructField("none", BooleanType()), StructField("text", StringType())])
    cut_ = made.select("rest", "none", "text", "runs", "copy").mapInArrow(run, schema)
    text = F.when(~F.col("none"), F.col("text"))
    return cut_.select(*(
        text.alias("text") if c == "text" else F.length(text).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col("rest")[c].alias(c)
        for c in names
    ))

"""SimHash near-duplicates by pivot distance tables.

Fingerprints: words ``[^\\x20\\x09-\\x0D]+`` of the A-Z lower-cased text, shingles of
``shingle`` words (a shorter text is one shingle, an empty one has fingerprint 0),
XXH64 with seed 42; a bit is set when more than half of the shingle hashes have it.
Two fingerprints link when at most ``max_distance`` bits differ; a group is a
connected component.

Every distinct fingerprint gets a row of its Hamming distances to ``PIVOTS``
reference fingerprints. By the triangle inequality no two fingerprints within
``max_distance`` bits differ by more in any coordinate, so a pair is discarded by
its largest coordinate difference and only survivors are compared bit by bit. A
table of distances can discard pairs but not propose them, so pairs are proposed
by bit blocks: of ``max_distance + 2`` blocks at least two are untouched by that
many changes, so linked fingerprints meet under at least one pair of blocks.
What meets under one key is linked by a search that leaves out what is already
reached and returns one row per reached fingerprint, never all pairs; a key
shared by more than ``KEY_SHARE`` fingerprints is dealt out in blocks by salt,
two salts at a time, so every pair still meets.

Defined results: null and empty texts have fingerprint zero and link like any
other; repeated rows come back each with the same values; a null ``doc_id``
never names a group (a group of null ids only has a null ``component_id``); an
empty table gives no rows; other columns are ignored by ``link``.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import store, texts, with_column
from panelcast.llm.components import components

SEED = 42
#: Shingle hashes of one text that are counted at a time.
BLOCK = 1 << 15
#: Reference fingerprints, each the XXH64 of its number.
PIVOTS = [xxhash.xxh64_intdigest(str(i).encode(), SEED) for i in range(16)]
#: Fingerprints under one key that one task links at a time.
KEY_SHARE = 20_000


def simhash(text: bytes, shingle: int = 3) -> int:
    """64-bit fingerprint of one UTF-8 text."""
    words = text.lower().split()  # ASCII only in bytes, both as the contract says
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n - shingle + 1, BLOCK):
        to = min(at + BLOCK, n - shingle + 1)
        h = [digest(joined[a : b - 1], SEED) for a, b in zip(starts[at:to], ends[at + shingle - 1 : to + shingle - 1])]
        ones += np.unpackbits(np.array(h, ">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n - shingle + 1).tobytes(), "big")


def with_fingerprint(docs: DataFrame, shingle: int = 3, text_col: str = "text", name: str = "fp") -> DataFrame:
    """``docs`` and the fingerprint of each text as a (signed) long."""

    def values(col):
        return pa.array(np.array([simhash(t, shingle) for t in texts(col)], np.uint64).view(np.int64))

    return with_column(docs, name, "long", values, text_col)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def distance_table(fp: Column) -> list[Column]:
    """Hamming distances to the pivots, eight to a long, one byte each."""
    out = []
    for at in range(0, len(PIVOTS), 8):
        packed = F.lit(0).cast("long")
        for i, p in enumerate(PIVOTS[at : at + 8]):
            packed = packed.bitwiseOR(F.shiftleft(F.bit_count(fp.bitwiseXOR(F.lit(signed(p)))).cast("long"), 8 * i))
        out.append(packed)
    return out


def block_keys(fp: Column, max_distance: int) -> Column:
    """Keys of a fingerprint, one per pair of its ``max_distance + 2`` bit blocks."""
    edges = np.linspace(0, 64, max_distance + 3).astype(int).tolist()
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return F.array(*(
        F.xxhash64(F.lit(k), fp.bitwiseAND(F.lit(signed(x | y)))) for k, (x, y) in enumerate(combinations(masks, 2))
    ))


def linked(fps: np.ndarray, table: np.ndarray, most: int) -> list[tuple[int, int]]:
    """(root, member) of every group among the fingerprints of one key, found by a search over those not yet reached."""
    left = np.argsort(table[:, 0], kind="stable")
    out = []
    while len(left) > 1:
        root, left = int(left[0]), left[1:]
        queue = [root]
        while queue and len(left):
            x = queue.pop()
            first = table[left, 0]
            lo, hi = np.searchsorted(first, [table[x, 0] - most, table[x, 0] + most + 1])
            near = lo + np.flatnonzero((np.abs(table[left[lo:hi]] - table[x]) <= most).all(1))
            near = near[np.bitwise_count(fps[left[near]] ^ fps[x]) <= most]
            if len(near):
                found = left[near].tolist()
                out += [(root, y) for y in found]
                queue += found
                left = np.delete(left, near)
    return out


def links(classes: DataFrame, max_distance: int = 3, key_share: int = KEY_SHARE) -> DataFrame:
    """``a``, ``b``: links between distinct fingerprints ``fp`` that connect all groups."""
    tables = [c.alias(f"t{i}") for i, c in enumerate(distance_table(F.col("fp")))]
    width = 2 + len(tables)
    keyed = classes.select("fp", F.explode(block_keys(F.col("fp"), max_distance)).alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.ceil(F.col("n") / key_share).cast("int").alias("shares"))
    salt = F.pmod(F.xxhash64("fp"), F.col("shares")).cast("int")
    other = F.explode(F.when(F.col("shares") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("shares") - 1)))
    dealt = keyed.join(shared, "key").withColumn("salt", salt).select("key", "fp", "salt", other.alias("other"))
    dealt = dealt.select(F.xxhash64("key", F.least("salt", "other"), F.greatest("salt", "other")).alias("cell"), "fp", *tables)

    def search(batches):
        rest = np.zeros((0, width), np.int64)
        for batch in batches:
            got = np.stack([c.to_numpy() for c in batch.columns], 1) if batch.num_rows else rest[:0]
            rest = np.concatenate([rest, got])
            if len(rest):
                cut = int(np.searchsorted(rest[:, 0], rest[-1, 0]))  # the last cell may go on
                yield from found(rest[:cut])
                rest = rest[cut:]
        yield from found(rest)

    def found(rows):
        if not len(rows):
            return
        fps, table = rows[:, 1].copy().view(np.uint64), np.ascontiguousarray(rows[:, 2:]).view(np.int8)
        at = np.flatnonzero(np.r_[True, rows[1:, 0] != rows[:-1, 0], True])
        pairs = [(i + x, i + y) for i, j in zip(at[:-1].tolist(), at[1:].tolist()) if j - i > 1 for x, y in linked(fps[i:j], table[i:j], max_distance)]
        if pairs:
            p = np.array(pairs)
            yield pa.RecordBatch.from_arrays([pa.array(rows[p[:, k], 1]) for k in (0, 1)], ["a", "b"])

    return dealt.repartition("cell").sortWithinPartitions("cell").mapInArrow(search, "a long, b long")


def groups(fingerprints: DataFrame, max_distance: int = 3, id_col: str = "doc_id", key_share: int = KEY_SHARE) -> DataFrame:
    """One row per distinct ``fp``: its smallest id ``rep``, its group's ``root`` fingerprint and ``component_id``."""
    classes = store(fingerprints.groupBy("fp").agg(F.min(id_col).alias("rep")), "fingerprints")
    found = components(links(classes, max_distance, key_share)).withColumnRenamed("node", "fp")
    member = classes.join(found, "fp")
    best = member.groupBy("root").agg(F.min("rep").alias("component_id"))
    label = member.join(best, "root").select("fp", "root", "component_id")
    return classes.join(label, "fp", "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNull(), F.col("rep")).otherwise(F.col("component_id")).alias("component_id"),
    )


def link(docs: DataFrame, shingle: int = 3, max_distance: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row."""
    fps = store(with_fingerprint(docs.select("doc_id", "text"), shingle).select("doc_id", "fp"), "fingerprints")
    # stored, so that both sides of the join are dealt anew and a hot fingerprint's rows can be split
    label = store(groups(fps, max_distance).select("fp", "component_id"), "groups")
    return fps.join(label, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_distance: int = 3) -> DataFrame:
    """The columns of ``docs``; of each group the row with the smallest ``doc_id`` (one of equal rows; nulls last)."""
    # rows by two hashes of id and text: keepers are chosen without texts, which are shuffled once, no fingerprint as key
    key = [F.xxhash64("doc_id", "text").alias("__k1"), F.hash("doc_id", "text").alias("__k2")]
    marked = with_fingerprint(docs.select("doc_id", "text", *key), shingle, name="fp")
    fps = store(marked.select("doc_id", "fp", "__k1", "__k2"), "fingerprints")
    label = groups(fps.select("doc_id", "fp"), max_distance).where(F.col("rep").eqNullSafe(F.col("component_id")))
    keeper = label.groupBy("root").agg(F.min("fp").alias("fp"), F.max("component_id").alias("__keep"))
    one = F.min(F.struct("__k1", "__k2")).alias("key")
    chosen = fps.join(keeper.select("fp", "__keep"), "fp").where(F.col("doc_id").eqNullSafe(F.col("__keep"))).groupBy("fp").agg(one)
    kept = docs.select("*", *key).join(chosen.select("key.*"), ["__k1", "__k2"], "left_semi")
    return kept.dropDuplicates(["__k1", "__k2"]).select(*docs.columns)

"""Windows of a fixed length that occur more than once in a corpus, as Spark jobs.

A text is shipped as its anchored runs (see ``anchors``): a run is the stretch of
text under consecutive windows with the same anchor. Equal windows have equal
anchors at equal offsets, so

* a run whose anchor occurs nowhere else holds no repeated window;
* equal runs (a class, by a 128-bit digest of the whole stretch) repeat in every window;
* different classes under one anchor may share some windows: only there the
  stretches themselves, one per class, are compared window by window.

How a group of such classes is compared is the caller's part (``compare``). A
group of more than ``GROUP`` classes is not compared in one task: its windows
become rows that Spark counts by digest. All counts are aggregated before their
shuffle, and rows join the counts in joins that Spark may split where a key is
hot, so no class, anchor or window is gathered in one place.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.anchors import runs, span_hashes
from panelcast.llm.common import store, utf8

#: Classes under one anchor that are compared in one task.
GROUP = 8_192
_KEY = ["h", "d1", "d2"]


@dataclass(frozen=True)
class Unit:
    """What a window is made of: ``length`` words or bytes; anchors are ``gram`` of them."""

    words: bool
    length: int
    gram: int

    @property
    def width(self) -> int:
        """Grams in a window, and so windows in a run at most."""
        return self.length - self.gram + 1

    @property
    def longs(self) -> int:
        return -(-self.width // 64)


class Text:
    """One text in units: ``size`` of them, the k-th in ``data[start(k):end(k)]``."""

    def __init__(self, raw: bytes, unit: Unit):
        self.data = raw
        if unit.words:
            words = raw.split()  # bytes split at \x20 and \x09-\x0D
            self.data = b" ".join(words)
            self.size = len(words)
            self._ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            self._starts = np.concatenate([[0], self._ends[:-1] + 1]) if words else np.zeros(0, np.int64)
        else:
            self.size, self._starts, self._ends = len(raw), None, None

    def start(self, k):
        return k if self._starts is None else self._starts[k]

    def end(self, k):
        return k + 1 if self._ends is None else self._ends[k]

    def stretch(self, first: int, windows: int, unit: Unit) -> bytes:
        return self.data[self.start(first) : self.end(first + windows - 1 + unit.length - 1)]

    def grams(self, unit: Unit) -> np.ndarray:
        n = self.size - unit.gram + 1
        data = np.frombuffer(self.data, np.uint8)
        if self._starts is None:
            return span_hashes(data, slice(0, n), slice(unit.gram, unit.gram + n))
        return span_hashes(data, self._starts[:n], self._ends[unit.gram - 1 :])

    def kept(self, covered: np.ndarray) -> bytes:
        """What is left without the covered units (words joined by one space)."""
        if self._starts is None:
            return np.frombuffer(self.data, np.uint8)[~covered].tobytes()
        keep = np.flatnonzero(~covered)
        if len(keep) == self.size:
            return self.data
        return b" ".join([self.data[a:b] for a, b in zip(self._starts[keep].tolist(), self._ends[keep].tolist())])


def run_rows(raw: bytes, unit: Unit):
    """Rows (anchor hash, digest, first window, windows, times, further first windows) of the distinct runs of a text."""
    if len(raw) < unit.length:
        return []
    text = Text(raw, unit)
    if text.size < unit.length:
        return []
    hashes = text.grams(unit)
    first, count, anchor = runs(hashes, unit.width)
    data, digest, seen = text.data, xxhash.xxh3_128_digest, {}
    a, b = text.start(first), text.end(first + count + unit.length - 2)
    for h, x, y, f, n in zip(hashes[anchor].view(np.int64).tolist(), a.tolist(), b.tolist(), first.tolist(), count.tolist()):
        d = digest(data[x:y])
        if (row := seen.get(d)) is None:
            seen[d] = [h, d, f, n, 1, None]
        else:
            row[4] += 1
            row[5] = (row[5] or b"") + f.to_bytes(4, "little")
    return list(seen.values())


def occurrences(docs: DataFrame, unit: Unit) -> DataFrame:
    """One row per distinct run of each text: ``h, d1, d2, id, tk, first, n, times, more``."""

    def run(batches):
        for batch in batches:
            ids, tks = batch.column("id").to_numpy(zero_copy_only=False), batch.column("tk").to_numpy(zero_copy_only=False)
            at, data = utf8(batch.column("text"))
            view = memoryview(data)
            own, rows = [], []

            def out():
                d = np.frombuffer(b"".join([r[1] for r in rows]), "<i8").reshape(-1, 2)
                i = np.array(own)
                return pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array(d[:, 0]), pa.array(d[:, 1]), pa.array(ids[i]), pa.array(tks[i]),
                     *(pa.array([r[k] for r in rows], pa.int32()) for k in (2, 3, 4)), pa.array([r[5] for r in rows], pa.binary())],
                    ["h", "d1", "d2", "id", "tk", "first", "n", "times", "more"],
                )

            for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                got = run_rows(bytes(view[a:b]), unit)
                rows += got
                own += [k] * len(got)
                if len(rows) > 50_000:
                    yield out()
                    own, rows = [], []
            if rows:
                yield out()

    return docs.mapInArrow(run, "h long, d1 long, d2 long, id long, tk int, first int, n int, times int, more binary")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, tk, text``: rows are told apart by id and a hash of the text (rows equal in both share their runs)."""
    id_, tk, text = row_key(docs, id_col, text_col)
    return docs.select(id_.alias("id"), tk.alias("tk"), text.alias("text"))


def unnamed(text: Column) -> Column:
    """What stands for the id of a row that has none."""
    return F.xxhash64(text).bitwiseOR(F.lit(-(1 << 63)))


def row_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[Column, Column, Column]:
    """Id, text hash and text of a row. A null id is replaced by a 64-bit hash of the text, made negative: any number of
    rows without id stay apart, and come before those with ids from 0 on."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return F.coalesce(F.col(id_col).cast("long"), unnamed(text)), F.hash(text), text


def given_id() -> Column:
    """The id of a keyed row as it came, null where there was none."""
    return F.nullif(F.col("id"), unnamed(F.col("text"))).alias("id")


def _stretches(rows: DataFrame, asked: DataFrame, unit: Unit, *, windows: bool) -> DataFrame:
    """The stretch of each asked class, from the text of its first occurrence; with ``windows`` a row per window instead."""
    wanted = asked.groupBy("id", "tk").agg(F.collect_list(F.struct("h", "d1", "d2", "first", "n")).alias("asked"))
    both = rows.join(wanted, ["id", "tk"]).dropDuplicates(["id", "tk"]).select("id", "tk", "text", "asked")
    names = ["h", "d1", "d2", "id", "tk", "first", "n", "stretch"] if not windows else ["w1", "w2", "off", "h", "d1", "d2", "id", "tk", "first"]

    def run(batches):
        for batch in batches:
            at, data = utf8(batch.column("text"))
            lists = batch.column("asked")
            flat, cut = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            h, d1, d2, first, n = (flat.field(k).to_numpy() for k in range(5))
            ids, tks = batch.column("id").to_numpy(), batch.column("tk").to_numpy()
            for k in range(batch.num_rows):
                text = Text(data[at[k] : at[k + 1]].tobytes(), unit)
                s = slice(int(cut[k]), int(cut[k + 1]))
                pairs = list(zip(first[s].tolist(), n[s].tolist()))
                if not windows:
                    m = len(pairs)
                    made = [h[s], d1[s], d2[s], np.full(m, ids[k]), np.full(m, tks[k], np.int32), first[s], n[s], pa.array([text.stretch(f, c, unit) for f, c in pairs], pa.binary())]
                else:
                    digests = b"".join([xxhash.xxh3_128_digest(text.stretch(f + o, 1, unit)) for f, c in pairs for o in range(c)])
                    w = np.frombuffer(digests, "<i8").reshape(-1, 2)
                    each = np.repeat(np.arange(s.start, s.stop), n[s])
                    off = np.concatenate([np.arange(c, dtype=np.int32) for _, c in pairs])
                    m = len(each)
                    made = [w[:, 0], w[:, 1], off, h[each], d1[each], d2[each], np.full(m, ids[k]), np.full(m, tks[k], np.int32), first[each]]
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in made], names)

    kinds = {"off": "int", "tk": "int", "first": "int", "n": "int", "stretch": "binary"}
    return both.mapInArrow(run, ", ".join(f"{c} {kinds.get(c, 'long')}" for c in names))


def _masks(unit: Unit, name: str) -> list[str]:
    return [f"{name}{k}" for k in range(unit.longs)]


def mask_rows(marks: list[tuple[tuple[int, int, int], np.ndarray, np.ndarray]], unit: Unit) -> pa.RecordBatch:
    """Rows of a comparison: per class its key and, as bits of longs, the windows that occur elsewhere and those that occur earlier."""
    def bits(which: int) -> np.ndarray:
        out = np.zeros((len(marks), unit.longs * 64), bool)
        for k, m in enumerate(marks):
            out[k, : len(m[which])] = m[which]
        return np.packbits(out, axis=1, bitorder="little").view("<i8")

    any_, prev = bits(1), bits(2)
    keys = np.array([m[0] for m in marks], np.int64).reshape(-1, 3)
    return pa.RecordBatch.from_arrays(
        [*(pa.array(np.ascontiguousarray(keys[:, k])) for k in range(3)), *(pa.array(np.ascontiguousarray(x[:, k])) for x in (any_, prev) for k in range(unit.longs))],
        [*_KEY, *_masks(unit, "any"), *_masks(unit, "prev")],
    )


def _compared(stretches: DataFrame, unit: Unit, compare) -> DataFrame:
    """Masks of the classes of each group, compared together in order of first occurrence."""

    def run(batches):
        rest: list[tuple] = []
        for batch in batches:
            rows = rest + list(zip(*(batch.column(c).to_pylist() for c in ("h", "d1", "d2", "n", "stretch"))))
            cut = next((i for i in range(len(rows) - 1, 0, -1) if rows[i - 1][0] != rows[-1][0]), 0)  # the last group may go on
            yield from made(rows[:cut])
            rest = rows[cut:]
        yield from made(rest)

    def made(rows):
        a = 0
        while a < len(rows):  # whole groups, about a megabyte of text at a time
            b, size = a, 0
            while b < len(rows) and (size < 1 << 20 or rows[b][0] == rows[b - 1][0]):
                size += len(rows[b][4])
                b += 1
            yield mask_rows(compare(rows[a:b], unit), unit)
            a = b

    schema = ", ".join(f"{c} long" for c in [*_KEY, *_masks(unit, "any"), *_masks(unit, "prev")])
    return stretches.repartition("h").sortWithinPartitions("h", "id", "tk", "first").mapInArrow(run, schema)


def _counted(windows: DataFrame, unit: Unit) -> DataFrame:
    """The same masks for the windows of very large groups, by counting window digests."""
    place = F.struct("id", "tk", "first")
    seen = windows.groupBy("w1", "w2").agg(F.count("*").alias("k"), F.min(place).alias("lead")).where("k > 1")
    met = windows.join(seen, ["w1", "w2"])
    long, bit = F.floor(F.col("off") / 64), F.pmod("off", F.lit(64))

    def mask(k: int, only: Column | None = None) -> Column:
        use = (long == k) if only is None else (long == k) & only
        return F.bit_or(F.when(use, F.call_function("shiftleft", F.lit(1).cast("long"), bit.cast("int"))).otherwise(F.lit(0).cast("long")))

    later = place > F.col("lead")
    return met.groupBy(*_KEY).agg(
        *(mask(k).alias(n) for k, n in enumerate(_masks(unit, "any"))), *(mask(k, later).alias(n) for k, n in enumerate(_masks(unit, "prev")))
    )


def marked(docs: DataFrame, unit: Unit, compare, *, keep_first: bool, group: int = GROUP) -> DataFrame:
    """``docs`` (``id, tk, text``) with ``runs``: (first window, windows, masks, further first windows) of every run that
    holds windows to be marked: those that occur anywhere else, or with ``keep_first`` those that occur earlier
    (order: id, text hash, position). Windows are judged on the input. ``copy`` is 1, or with ``keep_first`` the ordinal
    among rows equal in id and text: all windows of those after the first occur earlier."""
    found = store(occurrences(docs, unit), "runs")
    many = found.groupBy("h").agg(F.sum("times").alias("k")).where("k > 1").select("h")
    again = store(found.join(many, "h", "left_semi"), "repeated-runs")
    classes = again.groupBy(*_KEY).agg(
        F.sum("times").alias("total"), F.min(F.struct("id", "tk", "first")).alias("lead"), F.max("n").alias("n")
    )
    size = classes.groupBy("h").agg(F.count("*").alias("k")).where("k > 1")
    asked = classes.join(size, "h").select(*_KEY, "lead.*", "n", "k")
    near = _compared(_stretches(docs, asked.where(F.col("k") <= group), unit, windows=False), unit, compare)
    far = _counted(_stretches(docs, asked.where(F.col("k") > group), unit, windows=True), unit)
    shared = near.unionByName(far)
    judged = classes.join(shared, _KEY, "left").select(*_KEY, "total", "lead", *_masks(unit, "any"), *_masks(unit, "prev"))
    met = again.join(judged, _KEY)
    first = F.struct("id", "tk", "first") == F.col("lead")

    def mask(k: int) -> Column:
        some = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
        if keep_first:
            return F.when(first, some(f"prev{k}")).otherwise(F.lit(-1).cast("long"))
        return F.when(F.col("total") > 1, F.lit(-1).cast("long")).otherwise(some(f"any{k}"))

    # a further occurrence in the same text is never the first
    run = F.struct("first", "n", *(mask(k).alias(f"m{k}") for k in range(unit.longs)), "more")
    per_text = met.select("id", "tk", run.alias("run")).where(
        " OR ".join([*(f"run.m{k} <> 0" for k in range(unit.longs)), "run.more IS NOT NULL"])
    ).groupBy("id", "tk").agg(F.collect_set("run").alias("runs"))  # rows of equal id and text bring the same runs: each once
    if not keep_first:
        return docs.join(per_text, ["id", "tk"], "left").withColumn("copy", F.lit(1))
    # before the join, whose exchange and order of the texts it shares; any order will do, as the texts are equal
    copy = F.row_number().over(Window.partitionBy("id", "tk").orderBy("tk"))
    return docs.withColumn("copy", copy).join(per_text, ["id", "tk"], "left")


def covers(batch: pa.RecordBatch, unit: Unit):
    """Per row of ``runs`` and ``copy`` columns a function from the size of the text to its covered units."""
    col, later = batch.column("runs"), batch.column("copy").to_numpy() > 1
    flat, cut = col.flatten(), col.offsets.to_numpy()
    cut = cut - cut[0]
    firsts, n = flat.field(0).to_numpy().astype(np.int64), flat.field(1).to_numpy().astype(np.int64)
    masks = np.stack([flat.field(2 + k).to_numpy() for k in range(unit.longs)], 1) if len(flat) else np.zeros((0, unit.longs), np.int64)
    more = flat.field(2 + unit.longs)
    further = np.flatnonzero(np.asarray(more.is_valid()))
    valid = np.asarray(col.is_valid())

    def cover(k: int, size: int) -> np.ndarray:
        if later[k]:
            return np.full(size, size >= unit.length)
        edge = np.zeros(size + 1, np.int32)
        if valid[k]:
            s = slice(int(cut[k]), int(cut[k + 1]))
            whole = (masks[s] == -1).all(1)
            f, c = firsts[s][whole], n[s][whole]
            np.add.at(edge, f, 1)
            np.add.at(edge, f + c - 1 + unit.length, -1)
            part = np.flatnonzero(~whole) + s.start
            if len(part):
                bits = np.unpackbits(np.ascontiguousarray(masks[part]).view(np.uint8), axis=1, bitorder="little").astype(bool)
                bits &= np.arange(bits.shape[1]) < n[part][:, None]
                row, off = np.nonzero(bits)
                np.add.at(edge, firsts[part][row] + off, 1)
                np.add.at(edge, firsts[part][row] + off + unit.length, -1)
            for i in further[np.searchsorted(further, s.start) : np.searchsorted(further, s.stop)].tolist():
                f = np.frombuffer(more[i].as_py(), "<i4").astype(np.int64)
                np.add.at(edge, f, 1)
                np.add.at(edge, f + n[i] - 1 + unit.length, -1)
        return np.cumsum(edge[:-1]) > 0

    return cover

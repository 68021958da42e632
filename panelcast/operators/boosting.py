"""Histogram-boosted trees, all fits of a run in lock step (MOD-4, MOD-5, CV-3, CV-4, SEL-3).

Rows are binned once per dataset and kept as blocks: one row of a Spark table per
(fit, block of at most about ``BLOCK_ROWS`` rows) with the bin codes, the target,
the row hashes and the current score. A numeric column has at most ``BINS`` bins cut
at quantiles; a categorical column is one column of level codes whose splits are
"this level or not", the splits of its one-hot columns.

A fit with several blocks exchanges histograms: one job per growing step sums the
(node, bin) gradients, hessians and counts of all its blocks, for every such fit at
once, and only the best split of each node comes back. A fit with one block has
nothing to exchange, so its task goes on through the steps of up to ``ROUND`` trees,
with the sibling's histogram by subtraction. Both use the same ``Growth``. After
each round the new trees are added to the scores and the table is written anew in
the shared checkpoint folder, so a lost executor costs one round at most.

Three ways to grow: ``leaf`` (best leaf first, up to ``leaves``; across blocks the
children of all leaves that may still be split are prepared in the same step),
``depth`` (every leaf down to ``depth``) and ``symmetric`` (one split per level for
all leaves, the tree is a table of 2^depth values). Rows are drawn per tree by a
hash of the row, columns by the tree's number: the same in every task and retry.
"""

from __future__ import annotations

import heapq
import math
import pickle
import uuid
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.session import ensure_checkpoint_dir

#: Bins of a numeric column; rows that a block holds (about, dealt by hash); trees between two writes of the scores.
BINS, BLOCK_ROWS, ROUND = 255, 65_536, 50
#: Blocks of a state file.
FILE_BLOCKS = 1
STATE = "fit int, block int, n int, codes binary, y binary, key binary, score binary"


@dataclass(frozen=True)
class Params:
    """A boosted model's settings."""

    iterations: int
    step: float
    grow: str = "depth"  # leaf, depth or symmetric
    depth: int | None = None
    leaves: int | None = None
    l2: float = 1.0
    min_rows: int = 1
    min_hessian: float = 0.0
    rows: float = 1.0  # share of the rows that a tree sees
    columns: float = 1.0  # share of the features that a tree sees
    poisson: bool = False
    hessian_shift: float = 0.0  # the Poisson hessian is exp(score + shift)
    max_value: float | None = None  # bound of a leaf's value before the step

    @property
    def most_leaves(self) -> int:
        return self.leaves or (2 ** self.depth if self.depth is not None else 2)


@dataclass
class Layout:
    """Binned columns: numeric ones with upper bin edges, categorical ones with levels."""

    edges: list[np.ndarray]
    levels: list[list[str]]
    widths: np.ndarray = field(init=False)
    start: np.ndarray = field(init=False)  # first histogram cell of a column
    column: np.ndarray = field(init=False)  # column of a cell
    code: np.ndarray = field(init=False)  # bin or level of a cell
    level: np.ndarray = field(init=False)  # whether a cell is a level
    feature: np.ndarray = field(init=False)  # feature of a cell: a numeric column, or one level
    open: np.ndarray = field(init=False)  # whether a split may follow a cell

    def __post_init__(self):
        # one more code for levels that the fit has not seen
        self.widths = np.array([len(e) + 1 for e in self.edges] + [len(v) + 1 for v in self.levels], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.widths)[:-1]]).astype(np.int64)
        self.column = np.repeat(np.arange(len(self.widths)), self.widths)
        self.code = np.arange(self.widths.sum()) - self.start[self.column]
        self.level = self.column >= len(self.edges)
        # the last bin of a column has nothing to its right, an unseen level has no rows
        self.open = self.code < self.widths[self.column] - 1
        self.feature = np.where(self.level, len(self.edges) + np.cumsum(self.level & self.open) - 1, self.column)

    @property
    def dtype(self):
        return np.uint16 if self.widths.max(initial=0) <= 1 << 16 else np.uint32

    def codes(self, numbers: np.ndarray, names: list) -> np.ndarray:
        """Columns x rows."""
        out = np.zeros((len(self.widths), len(numbers)), self.dtype)
        for j, e in enumerate(self.edges):
            out[j] = np.searchsorted(e, numbers[:, j], "left")
        for j, levels in enumerate(self.levels):
            known = {v: i for i, v in enumerate(levels)}
            out[len(self.edges) + j] = [known.get(v, len(levels)) for v in names[j]]
        return out

    def drawn(self, share: float, seed: int, tree: int) -> np.ndarray:
        """Cells whose feature the tree may split on."""
        if share >= 1:
            return self.open
        n = int(self.feature.max(initial=-1)) + 1
        kept = np.zeros(n, bool)
        kept[np.random.default_rng((seed, tree)).permutation(n)[: max(1, int(share * n))]] = True
        return self.open & kept[self.feature]


def drawn_rows(key: np.ndarray, share: float, seed: int, tree: int) -> np.ndarray:
    """Which rows a tree sees, by a mixed hash of row, seed and tree."""
    if share >= 1:
        return np.ones(len(key), bool)
    with np.errstate(over="ignore"):
        z = key + np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 % 2**64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return (z >> np.uint64(11)).astype(np.float64) * 2.0**-53 < share


def gradients(y: np.ndarray, score: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    if not p.poisson:
        return score - y, np.ones(len(y))
    mu = np.exp(np.minimum(score, 50.0))
    return mu - np.maximum(y, 0.0), mu * math.exp(p.hessian_shift)


def histogram(cells: np.ndarray, rows: np.ndarray, g: np.ndarray, h: np.ndarray, width: int) -> np.ndarray:
    """Sums of gradients and hessians and the count per cell (3 x width); ``cells`` is columns x rows."""
    at = cells[:, rows].ravel()
    k = len(cells)
    count = np.bincount(at, minlength=width).astype(np.float64)
    hess = count if (h is None) else np.bincount(at, np.tile(h[rows], k), width)
    return np.stack([np.bincount(at, np.tile(g[rows], k), width), hess, count])


def split_gains(hist: np.ndarray, total: np.ndarray, lay: Layout, p: Params, may: np.ndarray):
    """Gain of a split after each cell (left: up to the bin, or all but the level), and the sums on the left."""
    run = np.cumsum(hist, axis=1)
    before = np.where(lay.start > 0, run[:, lay.start - 1], 0.0)
    left = np.where(lay.level, total[:, None] - hist, run - before[:, lay.column])
    right = total[:, None] - left
    with np.errstate(divide="ignore", invalid="ignore"):
        side = lambda s: np.where(s[2] > 0.5, s[0] ** 2 / (s[1] + p.l2), 0.0)
        gain = side(left) + side(right) - (total[0] ** 2 / (total[1] + p.l2) if total[2] > 0.5 else 0.0)
    if p.grow != "symmetric":
        fits = (np.minimum(left[2], right[2]) >= max(p.min_rows, 1) - 0.5) & (np.minimum(left[1], right[1]) >= p.min_hessian)
        may = may & fits
    return np.where(may, gain, -np.inf), left


def total_of(hist: np.ndarray, lay: Layout) -> np.ndarray:
    return hist[:, : lay.widths[0]].sum(1)


class Growth:
    """A tree that is being grown: which nodes need their best split next, and what the tree is in the end."""

    def __init__(self, p: Params):
        self.p = p
        self.total, self.depth, self.kids, self.cut = {}, {0: 0}, {}, {}  # node -> sums, depth, children, best split
        self.level = [0]

    # a best split: (gain, cell, sums on the left), or None
    def expand(self, node: int) -> list[int]:
        """Children of a node at its best split; returns those that may be split on."""
        if node not in self.kids:
            a = len(self.depth)
            self.kids[node] = (a, a + 1)
            left = self.cut[node][2]
            for kid, total in ((a, left), (a + 1, self.total[node] - left)):
                self.depth[kid], self.total[kid] = self.depth[node] + 1, total
                if self.p.depth is not None and self.depth[kid] >= self.p.depth:
                    self.cut[kid] = None
        return [kid for kid in self.kids[node] if kid not in self.cut]

    def grown(self) -> tuple[set, list[int]]:
        """Nodes split for good, and those to expand next (the first of them is needed, the others may be)."""
        done, leaves = set(), 1
        queue = [(-self.cut[0][0], 0)] if self.cut.get(0) else []
        while queue and leaves < self.p.most_leaves:
            gain, node = heapq.heappop(queue)
            if node not in self.kids or any(kid not in self.cut for kid in self.kids[node]):
                rest = [n for _, n in heapq.nsmallest(self.p.most_leaves - leaves - 1, queue) if n not in self.kids]
                return done, [node, *rest]
            done.add(node)
            leaves += 1
            for kid in self.kids[node]:
                if self.cut[kid]:
                    heapq.heappush(queue, (-self.cut[kid][0], kid))
        return done, []

    def wanted(self, ahead: bool) -> list[int]:
        """Nodes whose best split is needed next; empty once the tree is grown."""
        if 0 not in self.cut:
            return [0]
        if self.p.grow == "symmetric":
            if not self.cut[self.level[0]] or self.depth[self.level[0]] >= self.p.depth:
                return []
            for node in self.level:
                self.expand(node)
            self.level = [kid for node in self.level for kid in self.kids[node]]
            return [] if self.depth[self.level[0]] >= self.p.depth else self.level
        while True:
            _, nodes = self.grown()
            need = [kid for node in (nodes if ahead or self.p.grow == "depth" else nodes[:1]) for kid in self.expand(node)]
            if need or not nodes:
                return need

    def learn(self, nodes: list[int], hists: list[np.ndarray], lay: Layout, may: np.ndarray) -> None:
        """The best splits of nodes from their histograms (one split for all of them in a symmetric tree)."""
        found = []
        for node, hist in zip(nodes, hists):
            if node not in self.total:
                self.total[node] = total_of(hist, lay)
            found.append(split_gains(hist, self.total[node], lay, self.p, may))
        joint = sum(gain for gain, _ in found) if self.p.grow == "symmetric" else None
        for node, (gain, left) in zip(nodes, found):
            best = int(np.argmax(gain if joint is None else joint))
            worth = float((gain if joint is None else joint)[best])
            self.cut[node] = (worth, best, left[:, best]) if worth > 1e-12 else None

    def value(self, node: int) -> float:
        g, h, n = self.total[node]
        v = -g / (h + self.p.l2) if n > 0.5 and h + self.p.l2 > 0 else 0.0
        return float(v if self.p.max_value is None else np.clip(v, -self.p.max_value, self.p.max_value))

    def routes(self, lay: Layout, inner=None) -> Tree:
        """The tree that splits the ``inner`` nodes (all expanded ones, if not given)."""
        inner = set(self.kids) if inner is None else inner
        n = len(self.depth)
        cell = np.array([self.cut[i][1] if i in inner else 0 for i in range(n)])
        left = np.array([self.kids[i][0] if i in inner else -1 for i in range(n)])
        return Tree(lay.column[cell], lay.code[cell], lay.level[cell], left, np.array([self.value(i) if i in self.total else 0.0 for i in range(n)]),
                    np.bincount(lay.feature[cell[left >= 0]], minlength=int(lay.feature.max(initial=-1)) + 1))

    def finish(self, lay: Layout):
        if self.p.grow != "symmetric":
            return self.routes(lay, self.grown()[0])
        cells, node = [], 0
        while node in self.kids:
            cells.append(self.cut[node][1])
            node = self.kids[node][0]
        leaves = [0]
        for _ in cells:
            leaves = [kid for n in leaves for kid in self.kids[n]]
        cells = np.array(cells, np.int64)
        return Table(lay.column[cells], lay.code[cells], lay.level[cells], np.array([self.value(n) for n in leaves]),
                     np.bincount(lay.feature[cells], minlength=int(lay.feature.max(initial=-1)) + 1))


@dataclass
class Tree:
    """Split column, code and kind, left child (the right one follows; -1: a leaf) and value per node."""

    column: np.ndarray
    code: np.ndarray
    level: np.ndarray
    left: np.ndarray
    values: np.ndarray
    splits: np.ndarray  # number of splits per feature

    def nodes(self, codes: np.ndarray) -> np.ndarray:
        at = np.zeros(codes.shape[1], np.int64)
        rows = np.arange(codes.shape[1])
        while True:
            rows = rows[self.left[at[rows]] >= 0]
            if not len(rows):
                return at
            node = at[rows]
            c = codes[self.column[node], rows]
            right = np.where(self.level[node], c == self.code[node], c > self.code[node])
            at[rows] = self.left[node] + right

    def predict(self, codes: np.ndarray) -> np.ndarray:
        return self.values[self.nodes(codes)]


@dataclass
class Table:
    """Symmetric tree: a split per level and 2^levels values."""

    column: np.ndarray
    code: np.ndarray
    level: np.ndarray
    values: np.ndarray
    splits: np.ndarray

    def predict(self, codes: np.ndarray) -> np.ndarray:
        at = np.zeros(codes.shape[1], np.int64)
        for column, code, level in zip(self.column, self.code, self.level):
            at = 2 * at + (codes[column] == code if level else codes[column] > code)
        return self.values[at]


class Block:
    """One row of the state table."""

    def __init__(self, row: dict, lay: Layout):
        self.n = row["n"]
        self.codes = np.frombuffer(row["codes"], lay.dtype).reshape(len(lay.widths), self.n)
        self.y, self.score = np.frombuffer(row["y"]), np.frombuffer(row["score"])
        self.key = np.frombuffer(row["key"], np.uint64)
        self.cells = self.codes.astype(np.int64) + lay.start[:, None]


def grow_tree(block: Block, lay: Layout, p: Params, score: np.ndarray, seed: int, number: int):
    """One tree over one block that holds all rows of its fit."""
    g, h = gradients(block.y, score, p)
    may, width = lay.drawn(p.columns, seed, number), len(lay.column)
    h = h if p.poisson else None
    rows = {0: np.flatnonzero(drawn_rows(block.key, p.rows, seed, number))}
    hists = {0: histogram(block.cells, rows[0], g, h, width)}
    grown = Growth(p)
    while nodes := grown.wanted(ahead=False):
        for parent in {node for node, kids in grown.kids.items() if node in rows and any(k in nodes for k in kids)}:
            one, two = grown.kids[parent]
            cell, mine = grown.cut[parent][1], rows.pop(parent)
            c = block.codes[lay.column[cell]][mine]
            right = c == lay.code[cell] if lay.level[cell] else c > lay.code[cell]
            rows[one], rows[two] = mine[~right], mine[right]
            small, large = (one, two) if len(rows[one]) <= len(rows[two]) else (two, one)
            hists[small] = histogram(block.cells, rows[small], g, h, width)
            hists[large] = hists.pop(parent) - hists[small]
        grown.learn(nodes, [hists[n] for n in nodes], lay, may)
    return grown.finish(lay)


def _rows(batches):
    for batch in batches:
        yield from batch.to_pylist()


def _grow_alone(shared, first: int, count: int):
    """Task: the next trees of every fit that has one block."""

    def run(batches):
        fits, seed = shared.value
        for row in _rows(batches):
            lay, p = fits[row["fit"]]
            block, out = Block(row, lay), []
            score = block.score.copy()
            for number in range(first, min(first + count, p.iterations)):
                out.append(grow_tree(block, lay, p, score, seed, number))
                score += p.step * out[-1].predict(block.codes)
            yield pa.RecordBatch.from_arrays([pa.array([row["fit"]], pa.int32()), pa.array([pickle.dumps(out)], pa.binary())], ["fit", "made"])

    return run


def _grow_across(state: DataFrame, fits: dict, seed: int, number: int, new: dict) -> dict:
    """One tree for each of the given fits, whose rows fill several blocks: a job per growing step for all of them."""
    growths = {f: Growth(p) for f, (_, p) in fits.items()}
    spark, out = state.sparkSession, {}
    while True:
        nodes = {f: n for f, g in growths.items() if f not in out and (n := g.wanted(ahead=True))}
        for f in growths:
            if f not in out and f not in nodes:
                out[f] = growths[f].finish(fits[f][0])
        if not nodes:
            return out
        shared = spark.sparkContext.broadcast((fits, {f: (growths[f], n) for f, n in nodes.items()}, {f: new[f] for f in nodes}))

        def sums(batches):
            # what the blocks of a task have in common is added up before the shuffle
            fits, open_, new = shared.value
            part = {}
            for row in _rows(batches):
                f = row["fit"]
                lay, p = fits[f]
                grown, wanted = open_[f]
                block = Block(row, lay)
                score = block.score + p.step * sum(t.predict(block.codes) for t in new[f])
                g, h = gradients(block.y, score, p)
                at = grown.routes(lay).nodes(block.codes)
                at[~drawn_rows(block.key, p.rows, seed, number)] = -1
                made = np.stack([histogram(block.cells, np.flatnonzero(at == n), g, h if p.poisson else None, len(lay.column)) for n in wanted])
                part[f] = part[f] + made if f in part else made
            for f, made in part.items():
                yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), pa.array([made.tobytes()], pa.binary())], ["fit", "made"])

        def best(key, table):
            fits, open_, _ = shared.value
            f = key[0].as_py()
            lay, p = fits[f]
            grown, wanted = open_[f]
            hist = sum(np.frombuffer(b.as_buffer()).reshape(len(wanted), 3, -1) for b in table.column("made"))
            grown.learn(wanted, list(hist), lay, lay.drawn(p.columns, seed, number))
            found = [(n, grown.total[n], grown.cut[n]) for n in wanted]
            return pa.table({"fit": pa.array([f], pa.int32()), "made": pa.array([pickle.dumps(found)], pa.binary())})

        kind = "fit int, made binary"
        for row in state.where(F.col("fit").isin(*nodes)).mapInArrow(sums, kind).groupBy("fit").applyInArrow(best, kind).collect():
            grown = growths[row["fit"]]
            for n, total, cut in pickle.loads(row["made"]):
                grown.total[n], grown.cut[n] = total, cut


def _scored(state: DataFrame, fits: dict, new: dict) -> DataFrame:
    """The state with the new trees added to the scores."""
    shared = state.sparkSession.sparkContext.broadcast((fits, new))
    at = state.columns.index("score")

    def run(batches):
        fits, new = shared.value
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                lay, p = fits[row["fit"]]
                block = Block(row, lay)
                made.append((block.score + p.step * sum((t.predict(block.codes) for t in new[row["fit"]]), np.zeros(block.n))).tobytes())
            yield batch.set_column(at, "score", pa.array(made, pa.binary()))

    return state.mapInArrow(run, STATE)


class _Folder:
    """State tables in the shared checkpoint folder; the one before goes when the next is written, the last with ``close``."""

    def __init__(self, spark):
        self.spark, self.path, self.number = spark, f"{ensure_checkpoint_dir(spark)}/boosting-{uuid.uuid4().hex}", 0

    def put(self, df: DataFrame) -> DataFrame:
        self.number += 1
        path = f"{self.path}/{self.number}"
        df.write.parquet(path)
        self._drop(f"{self.path}/{self.number - 1}")
        return self.spark.read.schema(STATE).parquet(path)

    def _drop(self, path: str) -> None:
        gone = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        gone.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(gone, True)

    def close(self) -> None:
        self._drop(self.path)


def quantile_edges(df: DataFrame, cols: list[str], bins: int = BINS) -> list[np.ndarray]:
    """Edges half way between neighbouring quantiles (all values, where a column has few)."""
    if not cols:
        return []
    cuts = df.approxQuantile(cols, [i / bins for i in range(bins + 1)], 0.25 / bins)
    out = []
    for values in cuts:
        v = np.unique(np.array(values, np.float64))
        out.append((v[:-1] + v[1:]) / 2 if len(v) > 1 else np.zeros(0))
    return out


@dataclass
class Dataset:
    """Training rows of one or more fits: filled columns, the target ``_y`` and the row hash ``_key``."""

    df: DataFrame
    layout: Layout
    rows: int
    mean: float
    positive_mean: float  # with negative targets as 0, for the Poisson models

    @property
    def n_blocks(self) -> int:
        return max(1, -(-self.rows // BLOCK_ROWS))

    def blocks(self, members: list[int], start: dict[int, float]) -> DataFrame:
        lay, n = self.layout, self.n_blocks

        def pack(table):
            table = table.sort_by([("_key", "ascending"), ("_spread", "ascending")])
            numbers = np.array(table.column("_numbers").combine_chunks().flatten()).reshape(table.num_rows, len(lay.edges))
            names = np.array(table.column("_names").combine_chunks().flatten().to_pylist(), object).reshape(table.num_rows, len(lay.levels)).T
            y, key = table.column("_y").to_numpy(), table.column("_key").to_numpy().view(np.uint64)
            k = len(members)
            same = [pa.array([v] * k, pa.binary()) for v in (lay.codes(numbers, list(names)).tobytes(), y.tobytes(), key.tobytes())]
            return pa.table([
                pa.array(members, pa.int32()), pa.array([table.column("_block")[0].as_py()] * k, pa.int32()), pa.array([len(y)] * k, pa.int32()),
                *same, pa.array([np.full(len(y), start[m]).tobytes() for m in members], pa.binary())],
                names=["fit", "block", "n", "codes", "y", "key", "score"])

        dealt = self.df.withColumn("_spread", F.monotonically_increasing_id())
        dealt = dealt.withColumn("_block", F.pmod(F.xxhash64("_key", "_spread"), F.lit(n)).cast("int"))
        return dealt.groupBy("_block").applyInArrow(pack, STATE)


@dataclass
class Booster:
    """A fitted ensemble over binned columns."""

    layout: Layout
    params: Params
    start: float
    trees: list

    def predict(self, numbers: np.ndarray, names: list) -> np.ndarray:
        codes = self.layout.codes(numbers, names)
        score = np.full(codes.shape[1], self.start)
        for t in self.trees:
            score += self.params.step * t.predict(codes)
        return np.exp(np.minimum(score, 50.0)) if self.params.poisson else score

    def split_counts(self) -> np.ndarray:
        """Splits per feature: numeric columns in order, then the levels of each categorical one."""
        return sum((t.splits for t in self.trees), np.zeros(int(self.layout.feature.max(initial=-1)) + 1, np.int64))


def fit_all(datasets: dict, fits: list[tuple[object, Params]], seed: int) -> list[Booster]:
    """Fits (key of the dataset, settings) in lock step; an error in any ends all."""
    if not fits:
        return []
    starts = [math.log(max(datasets[k].positive_mean, 1e-9)) if p.poisson else datasets[k].mean for k, p in fits]
    boosters = [Booster(datasets[k].layout, p, s, []) for (k, p), s in zip(fits, starts)]
    usable = [i for i, (k, p) in enumerate(fits) if datasets[k].rows and len(datasets[k].layout.widths)]
    if not usable:
        return boosters
    spark = next(iter(datasets.values())).df.sparkSession
    parts = []
    for k, data in datasets.items():
        members = [i for i in usable if fits[i][0] == k]
        if members:
            parts.append(data.blocks(members, {i: starts[i] for i in members}))
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    folder = _Folder(spark)
    try:
        # a file for a few blocks, in the order of the fits
        files = -(-sum(datasets[fits[i][0]].n_blocks for i in usable) // FILE_BLOCKS)
        state = folder.put(whole.repartitionByRange(files, "fit", "block"))
        blocks = {r["fit"]: r["n"] for r in state.groupBy("fit").agg(F.count(F.lit(1)).alias("n")).collect()}
        settings = {i: (boosters[i].layout, fits[i][1]) for i in usable}
        last = max(fits[i][1].iterations for i in usable)
        for first in range(0, last, ROUND):
            new = {i: [] for i in usable}
            running = [i for i in usable if fits[i][1].iterations > first]
            alone = [i for i in running if blocks[i] == 1]
            if alone:
                shared = spark.sparkContext.broadcast((settings, seed))
                mine = state.where(F.col("fit").isin(*alone))
                for row in mine.mapInArrow(_grow_alone(shared, first, ROUND), "fit int, made binary").collect():
                    new[row["fit"]] = pickle.loads(row["made"])
            for number in range(first, min(first + ROUND, last)):
                across = {i: settings[i] for i in running if blocks[i] > 1 and fits[i][1].iterations > number}
                if across:
                    for i, tree in _grow_across(state, across, seed, number, new).items():
                        new[i].append(tree)
            for i in running:
                boosters[i].trees += new[i]
            if first + ROUND < last:
                state = folder.put(_scored(state, settings, new))
    finally:
        folder.close()
    return boosters


def adjusted(p: Params, max_iter=None, max_depth=None, step_size=None, subsample=None, min_instances=None, num_leaves=None) -> Params:
    """Settings with grid parameters in place of the preset's."""
    given = {"iterations": max_iter, "depth": max_depth, "step": step_size, "rows": subsample, "min_rows": min_instances, "leaves": num_leaves}
    return replace(p, **{k: type(getattr(p, k) or 0)(v) for k, v in given.items() if v is not None})

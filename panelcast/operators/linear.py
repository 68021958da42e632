"""Penalised least squares from sums of products (MOD-2, MOD-3, COM-6..8, CV-3, CV-4, CV-6).

One aggregation gives, per segment of weeks, the sums of products of all columns.
A segment is a run of weeks that the same groups of rows (folds, the refit on all
rows) take in, so a group's sums are sums of segments and all groups, penalties
and models come from one pass over the rows.

What differs between groups is applied to the sums: a column enters as its value
(0 in the gaps, less a common centre) and as its gaps (0 or 1), so any median can
be filled in afterwards; levels enter as indicators, gaps as one more level. The
sums are (columns + levels)^2 numbers per segment, whatever the number of rows.

Ridge solves the normal equations; elastic net and lasso go by coordinate descent
on them, from the solution of the penalty before.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.metrics import finite

#: Cells of the dense rows that a task multiplies at once (32 MB); rows of a sum's matrix per group of the final sum.
CELLS, STRIPE = 4 << 20, 64


@dataclass
class Columns:
    """What the sums are over: numeric columns with a centre, categorical ones with their levels."""

    numeric: list
    centres: dict
    levels: dict  # categorical column -> levels
    y_centre: float

    @property
    def width(self) -> int:
        return 2 * len(self.numeric) + sum(len(v) + 1 for v in self.levels.values()) + 2

    def dense(self, numbers: np.ndarray, names: list, y: np.ndarray) -> np.ndarray:
        """Rows x width: values, gaps, levels and missing level of each category, target, one."""
        n, p = numbers.shape
        out = np.zeros((n, self.width))
        gap = np.isnan(numbers)
        out[:, :p] = np.where(gap, 0.0, numbers - np.array([self.centres[c] for c in self.numeric]))
        out[:, p : 2 * p] = gap
        at = 2 * p
        for col, levels in zip(names, self.levels.values()):
            known = {v: i for i, v in enumerate(levels)} | {None: len(levels)}
            place = np.array([known.get(v, -1) for v in col], np.int64)
            out[np.flatnonzero(place >= 0), at + place[place >= 0]] = 1.0
            at += len(levels) + 1
        out[:, -2], out[:, -1] = y - self.y_centre, 1.0
        return out


def sums_of_products(df: DataFrame, cols: Columns, y: str, segment: str) -> dict[int, np.ndarray]:
    """Sums of products (width x width) per segment, over rows with a target."""
    width = cols.width
    numbers = F.array(*[F.coalesce(finite(F.col(c).cast("double")), F.lit(float("nan"))) for c in cols.numeric]).cast("array<double>")
    names = F.array(*[F.col(c).cast("string") for c in cols.levels]).cast("array<string>")
    rows = df.where(F.col(y).isNotNull()).select(
        F.col(segment).cast("int").alias("segment"), numbers.alias("numbers"), names.alias("names"), F.col(y).cast("double").alias("y"))

    def run(batches):
        total = {}
        step = max(1, CELLS // width)
        for batch in batches:
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                seg, y_ = part.column("segment").to_numpy(), part.column("y").to_numpy()
                x = part.column("numbers").flatten().to_numpy(zero_copy_only=False).reshape(len(y_), -1)
                flat = part.column("names").flatten().to_pylist()
                k = len(cols.levels)
                z = cols.dense(x, [flat[j::k] for j in range(k)], y_)
                for s in np.unique(seg):
                    zs = z[seg == s]
                    total[int(s)] = total.get(int(s), 0.0) + zs.T @ zs
        for s, m in total.items():
            stripes = range(0, width, STRIPE)
            yield pa.RecordBatch.from_arrays([
                pa.array([s] * len(stripes), pa.int32()), pa.array(list(stripes), pa.int32()),
                pa.array([m[a : a + STRIPE].tobytes() for a in stripes], pa.binary())], ["segment", "stripe", "sums"])

    def add(key, table):
        total = sum(np.frombuffer(b.as_buffer()) for b in table.column("sums"))
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int32()), "stripe": pa.array([key[1].as_py()], pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})

    kind = "segment int, stripe int, sums binary"
    out: dict = {}
    for r in rows.mapInArrow(run, kind).groupBy("segment", "stripe").applyInArrow(add, kind).collect():
        m = out.setdefault(r["segment"], np.zeros((width, width)))
        part = np.frombuffer(r["sums"]).reshape(-1, width)
        m[r["stripe"] : r["stripe"] + len(part)] = part
    return out


@dataclass
class Equations:
    """Centred normal equations of one group: its features are the scaled columns, then the levels."""

    xx: np.ndarray
    xy: np.ndarray
    n: float
    x_mean: np.ndarray
    y_mean: float

    def ridge(self, alpha: float) -> np.ndarray:
        """min |y - Xw|^2 + alpha |w|^2 (the shortest of equal solutions)."""
        a = self.xx + alpha * np.eye(len(self.xy))
        return np.linalg.solve(a, self.xy) if alpha > 0 else np.linalg.lstsq(a, self.xy, rcond=None)[0]

    def elastic_net(self, alpha: float, l1_ratio: float, start: np.ndarray | None = None, sweeps: int = 5000, tol: float = 1e-10) -> np.ndarray:
        """min |y - Xw|^2 / 2n + alpha l1 |w|_1 + alpha (1 - l1) / 2 |w|^2, by coordinate descent on the sums."""
        w = np.zeros(len(self.xy)) if start is None else start.copy()
        a, b = self.xx / self.n, self.xy / self.n
        lasso, square = alpha * l1_ratio, alpha * (1 - l1_ratio)
        rest = b - a @ w
        scale = max(1.0, float(np.abs(b).max(initial=0.0)))
        for _ in range(sweeps):
            moved = 0.0
            for j in range(len(w)):
                if a[j, j] <= 0:
                    continue
                rho = rest[j] + a[j, j] * w[j]
                new = np.sign(rho) * max(abs(rho) - lasso, 0.0) / (a[j, j] + square)
                if new != w[j]:
                    rest -= a[:, j] * (new - w[j])
                    moved = max(moved, abs(new - w[j]) * a[j, j])
                    w[j] = new
            if moved <= tol * scale:
                break
        return w

    def solve(self, alpha: float, l1_ratio: float = 0.0, start: np.ndarray | None = None) -> np.ndarray:
        return self.ridge(alpha) if l1_ratio == 0 else self.elastic_net(alpha, l1_ratio, start)


def equations(sums: np.ndarray, cols: Columns, pre) -> Equations:
    """A group's normal equations: its preprocessing's medians, scales, modes and levels put into its sums."""
    p = len(pre.numeric)
    to = []
    for j, c in enumerate(cols.numeric):
        v = np.zeros(cols.width)
        v[j], v[p + j] = 1.0, (pre.medians.get(c) or 0.0) - cols.centres[c]
        to.append(v / pre.scales[c])
    at = 2 * p
    for c, levels in cols.levels.items():
        place = {v: at + i for i, v in enumerate(levels)}
        for level in pre.levels[c]:
            v = np.zeros(cols.width)
            v[place[level]] = 1.0
            if level == pre.modes[c]:
                v[at + len(levels)] = 1.0
            to.append(v)
        at += len(levels) + 1
    a = np.array(to).reshape(-1, cols.width).T
    n, y_sum, x_sum = sums[-1, -1], sums[-2, -1], a.T @ sums[:, -1]
    xx, xy = a.T @ sums @ a, a.T @ sums[:, -2]
    shift = np.array([(cols.centres[c] - pre.means[c]) / pre.scales[c] for c in cols.numeric] + [0.0] * (a.shape[1] - p))
    return Equations(xx - np.outer(x_sum, x_sum) / n, xy - x_sum * y_sum / n, n, x_sum / n + shift, y_sum / n + cols.y_centre)


@dataclass
class LinearModel:
    """Coefficients of the scaled columns and the levels, as one column expression."""

    pre: object
    coef: np.ndarray
    intercept: float

    @classmethod
    def of(cls, pre, eq: Equations, coef: np.ndarray) -> LinearModel:
        return cls(pre, coef, float(eq.y_mean - eq.x_mean @ coef))

    def column(self):
        pre, out = self.pre, F.lit(self.intercept)
        for c, x, w in zip(pre.numeric, pre.filled_numbers(), self.coef):
            out = out + F.lit(float(w)) * (x - F.lit(pre.means[c])) / F.lit(pre.scales[c])
        at = len(pre.numeric)
        for c in pre.categorical:
            weights = [x for v, w in zip(pre.levels[c], self.coef[at:]) for x in (F.lit(v), F.lit(float(w)))]
            at += len(pre.levels[c])
            if weights:
                name = F.coalesce(F.col(c).cast("string"), F.lit(pre.modes[c]))
                out = out + F.coalesce(F.try_element_at(F.create_map(*weights), name), F.lit(0.0))
        return out

    def predict(self, df: DataFrame, out: str = "y_pred") -> DataFrame:
        return df.select("*", self.column().alias(out))

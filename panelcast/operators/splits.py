"""Time-ordered validation folds (CV-1, CV-2, SET-8).

Fold arithmetic runs on the sorted list of distinct weeks: a list bounded by
the calendar (hundreds of entries), never by data volume. The result is a
small ``(fold, yearweek, role)`` table that joins to the panel on yearweek.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def expanding_splits(n: int, k: int) -> list[tuple[range, range]]:
    """Expanding-window splits over n ordered positions (k folds, equal validation size n // (k+1))."""
    if k < 2 or k + 1 > n:
        raise ValueError(f"Cannot make {k} expanding splits of {n} positions")
    t = n // (k + 1)
    out = []
    for i in range(k):
        start = n - (k - i) * t
        out.append((range(0, start), range(start, start + t)))
    return out


def _cut_split(weeks: list[int]) -> list[tuple[list[int], list[int]]]:
    cut = int(len(weeks) * 0.8)
    if cut <= 0 or cut >= len(weeks):
        raise RuntimeError("too few weeks even for one split")
    return [(weeks[:cut], weeks[cut:])]


def rolling_splits(weeks, n_splits: int, min_train_weeks: int) -> list[tuple[list[int], list[int]]]:
    """CV-1: rolling-origin folds as (train weeks, validation weeks).

    < 12 weeks is an error; one split means an 80/20 cut; too few weeks shrink
    the fold count and the minimum; folds with too little training are dropped;
    none left falls back to the 80/20 cut.
    """
    weeks = sorted({int(w) for w in weeks})
    n = len(weeks)
    if n < 12:
        raise RuntimeError(f"{n} weeks are too few for rolling validation")
    if n_splits <= 1:
        return _cut_split(weeks)
    if n < min_train_weeks + n_splits:
        n_splits = max(2, min(3, n // 26))
        min_train_weeks = max(52, n - n_splits * 8)
    out = []
    for tr, va in expanding_splits(n, n_splits):
        if len(tr) < min_train_weeks:
            continue
        out.append(([weeks[i] for i in tr], [weeks[i] for i in va]))
    return out or _cut_split(weeks)


def inner_splits(weeks, n_splits: int, min_train_weeks: int = 52) -> list[tuple[list[int], list[int]]]:
    """CV-2: tuning folds; too few weeks -> none."""
    weeks = sorted({int(w) for w in weeks})
    n = len(weeks)
    if n < n_splits + 2:
        return []
    k = min(n_splits, max(2, n // 26))
    out = []
    for tr, va in expanding_splits(n, k):
        if len(tr) < min_train_weeks:
            continue
        out.append(([weeks[i] for i in tr], [weeks[i] for i in va]))
    return out


FOLD_SCHEMA = T.StructType([
    T.StructField("fold", T.IntegerType(), False),
    T.StructField("yearweek", T.IntegerType(), False),
    T.StructField("role", T.StringType(), False),
])


def fold_table(spark: SparkSession, splits) -> DataFrame:
    """(fold, yearweek, role in {train, valid}); at most weeks x folds rows."""
    rows = []
    for i, (tr, va) in enumerate(splits):
        rows += [(i, int(w), "train") for w in tr] + [(i, int(w), "valid") for w in va]
    return spark.createDataFrame(rows, FOLD_SCHEMA)


def distinct_weeks(df: DataFrame) -> list[int]:
    """Sorted distinct weeks of a panel (bounded by the calendar)."""
    return [int(r[0]) for r in df.select("yearweek").distinct().orderBy("yearweek").collect()]


def assign_folds(df: DataFrame, folds: DataFrame, role: str) -> DataFrame:
    """SET-8: the panel rows of each fold's training or validation weeks (broadcast equi-join on yearweek)."""
    f = F.broadcast(folds.where(F.col("role") == role).select("fold", "yearweek"))
    return df.join(f, "yearweek")

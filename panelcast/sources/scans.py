"""Scans, column resolution and normalisation of the weekly inputs (SRC-*, COL-1..8).

Every loader takes a DataFrame (or a table name / parquet path) and returns a
lazy DataFrame. Filters on ``yearweek`` are plain ``filter`` calls so Catalyst
pushes them into the parquet/JDBC scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast import config as C


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table name, or a parquet path when it contains a slash."""
    if "/" in name_or_path or name_or_path.endswith(".parquet"):
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def read_sql(spark: SparkSession, sql: str, params: dict | None = None, **frames: DataFrame) -> DataFrame:
    """SRC-10: named-parameter query (``:name`` markers, a missing parameter is an error).

    DataFrames passed as keywords are referenced as ``{name}`` in the text.
    """
    return spark.sql(sql, args=params or {}, **frames)


def pick_col(df: DataFrame, candidates, required: bool = True) -> str | None:
    """COL-1: exact match in candidate order, then case-insensitive."""
    cols = df.columns
    for c in candidates:
        if c in cols:
            return c
    lower = {c.lower(): c for c in cols}
    for c in candidates:
        if c.lower() in lower:
            return lower[c.lower()]
    if required:
        raise KeyError(f"none of the columns {list(candidates)} is there; the table has {cols}")
    return None


def safe_yearweek(df: DataFrame) -> DataFrame:
    """COL-2: yearweek must exist; cast to INT (ANSI cast: bad text is an error)."""
    if "yearweek" not in df.columns:
        raise KeyError(f"no yearweek column among {df.columns}")
    return df.withColumn("yearweek", F.col("yearweek").cast("int"))


def to_double(col) -> F.Column:
    """COL-3: coercing numeric cast, bad text -> NULL; NaN and +-inf -> NULL (COL-19)."""
    c = F.col(col) if isinstance(col, str) else col
    d = c.try_cast("double")
    return F.when(F.isnan(d) | (F.abs(d) == float("inf")), F.lit(None).cast("double")).otherwise(d)


def week_range_filter(df: DataFrame, start_week: int | None, end_week: int | None) -> DataFrame:
    """FIL-1: each bound optional."""
    if start_week is not None:
        df = df.filter(F.col("yearweek") >= int(start_week))
    if end_week is not None:
        df = df.filter(F.col("yearweek") <= int(end_week))
    return df


def load_source_weekly(df: DataFrame, data_source: str, start_week=None, end_week=None,
                       check_empty: bool = True) -> DataFrame:
    """SRC-1: source scan with an optional week range and a literal ``data_source``."""
    out = week_range_filter(safe_yearweek(df), start_week, end_week)
    if check_empty and out.isEmpty():
        raise RuntimeError(f"source {data_source} has no rows between weeks {start_week} and {end_week}")
    return out.withColumn("data_source", F.lit(data_source))


def load_source_total(df: DataFrame, data_source: str, start_week=None, end_week=None) -> DataFrame:
    """SRC-3: totals of one source, renamed, coerced and de-duplicated on (source, week, county).

    Duplicate keys keep the smallest non-null total: a deterministic keep-one rule
    that runs as a partial (map-side) aggregation, so a hot key cannot overload one task.
    """
    county = pick_col(df, C.COUNTY_COL_CANDIDATES)
    total = pick_col(df, ["total_count", "source_total_count"])
    out = df.filter(F.col("data_source") == data_source)
    out = week_range_filter(safe_yearweek(out), start_week, end_week)
    out = out.select(
        F.col("data_source").cast("string").alias("data_source"),
        "yearweek",
        F.col(county).cast("string").alias("county"),
        to_double(total).alias("source_total_count"),
    )
    return out.groupBy("data_source", "yearweek", "county").agg(F.min("source_total_count").alias("source_total_count"))


def load_weather(df: DataFrame | None, start_week=None, end_week=None) -> DataFrame | None:
    """SRC-2 + COL-6: weather scan; rename county, drop audit columns, one row per (week, county)."""
    if df is None:
        return None
    return normalize_weather(week_range_filter(safe_yearweek(df), start_week, end_week))


def normalize_weather(df: DataFrame) -> DataFrame:
    county = pick_col(df, C.COUNTY_COL_CANDIDATES)
    df = df.withColumnRenamed(county, "county") if county != "county" else df
    keep = [c for c in df.columns if c.lower() not in C.AUDIT_COLS and c not in ("yearweek", "county")]
    df = df.select("yearweek", F.col("county").cast("string").alias("county"), *keep)
    if not keep:
        return df.distinct()
    # keep one deterministic row per key: the smallest value tuple (partial aggregation, skew-safe)
    picked = df.groupBy("yearweek", "county").agg(F.min(F.struct(*keep)).alias("_w"))
    return picked.select("yearweek", "county", *[F.col(f"_w.{c}").alias(c) for c in keep])


def normalize_target(df: DataFrame) -> DataFrame:
    """COL-4 / COL-5: long or wide source layout -> (yearweek, county, disease, data_source, count)."""
    county = pick_col(df, C.COUNTY_COL_CANDIDATES)
    disease = pick_col(df, C.DISEASE_COL_CANDIDATES, required=False)
    count = pick_col(df, C.COUNT_COL_CANDIDATES, required=False)
    ds = [F.col("data_source")] if "data_source" in df.columns else []
    if count is not None:
        dis = F.col(disease).cast("string") if disease else F.lit("ALL")
        return df.select(
            "yearweek",
            F.col(county).cast("string").alias("county"),
            dis.alias("disease"),
            *ds,
            to_double(count).alias("count"),
        )
    lower = {c.lower(): c for c in df.columns}
    wide = {lower[k]: v for k, v in C.WIDE_DISEASE_COLUMNS.items() if k in lower}
    if not wide:
        raise KeyError(
            f"neither a count column ({C.COUNT_COL_CANDIDATES}) nor a column per disease "
            f"({list(C.WIDE_DISEASE_COLUMNS)}) among {df.columns}"
        )
    ids = ["yearweek", county] + (["data_source"] if ds else [])
    base = df.select(*ids, *[to_double(c).alias(c) for c in wide])
    long = base.unpivot(ids, list(wide), "_wide_col", "count")  # unpivot keeps NULL values
    mapping = F.create_map(*[x for k, v in wide.items() for x in (F.lit(k), F.lit(v))])
    return long.select(
        "yearweek",
        F.col(county).cast("string").alias("county"),
        mapping[F.col("_wide_col")].alias("disease"),
        *ds,
        "count",
    )


def exog_columns(df: DataFrame) -> list[str]:
    """COL-7: numeric (and boolean) columns outside the exclusion set."""
    out = []
    for f in df.schema.fields:
        if f.name in C.EXOG_EXCLUDED:
            continue
        if isinstance(f.dataType, (T.NumericType, T.BooleanType)):
            out.append(f.name)
    return out


def load_profile(df: DataFrame, label_cols=("data_source",)) -> DataFrame:
    """SRC-12: rows, min and max yearweek of a scan."""
    return df.groupBy(*label_cols).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("yearweek").alias("min_yearweek"),
        F.max("yearweek").alias("max_yearweek"),
    )


def load_source(spark: SparkSession, registry: C.SourceRegistry, data_source: str, start_week=None, end_week=None,
                check_empty: bool = True) -> DataFrame:
    """SRC-1 + SRC-11: resolve the source's table in the registry (unknown source -> error), scan, normalise."""
    table = registry.table_for(data_source)
    return normalize_target(load_source_weekly(read_table(spark, table), data_source, start_week, end_week, check_empty))

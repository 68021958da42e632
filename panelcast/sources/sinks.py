"""Sinks (SNK-1..6): append, keyed partition replace, statements, and report outputs.

Tables are catalog tables or parquet paths. Nothing is collected to the driver.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.session import reliable_checkpoint

# SNK-4: schemas of the three output tables
FORECAST_SCHEMA = T.StructType([
    T.StructField("data_source", T.StringType()), T.StructField("disease", T.StringType()),
    T.StructField("county", T.StringType()), T.StructField("yearweek", T.IntegerType()),
    T.StructField("lead_week", T.IntegerType()), T.StructField("forecast_count", T.DoubleType()),
    T.StructField("forecast_count_rounded", T.LongType()), T.StructField("model_name", T.StringType()),
    T.StructField("model_layer", T.StringType()), T.StructField("model_task", T.StringType()),
    T.StructField("model_scope", T.StringType()),
])
BASE_PREDICTION_SCHEMA = T.StructType([
    T.StructField("data_source", T.StringType()), T.StructField("disease", T.StringType()),
    T.StructField("county", T.StringType()), T.StructField("yearweek", T.IntegerType()),
    T.StructField("lead_week", T.IntegerType()), T.StructField("base_model", T.StringType()),
    T.StructField("forecast_count", T.LongType()), T.StructField("model_task", T.StringType()),
    T.StructField("model_scope", T.StringType()),
])

METRIC_SCHEMA = T.StructType([
    *(T.StructField(n, T.StringType()) for n in (
        "data_source", "model_task", "model_scope", "model_layer", "model_name", "meta_model", "meta_eval_type", "prediction_type",
        "metric_level", "disease", "county")),
    T.StructField("lead_week", T.IntegerType()), T.StructField("n_obs", T.LongType()),
    *(T.StructField(n, T.DoubleType()) for n in (
        "MAE", "RMSE", "MAPE", "sMAPE", "WAPE", "Bias", "Pearson", "HitRate", "y_true_sum", "y_pred_sum", "y_true_mean", "y_pred_mean")),
])
OUTPUT_TABLES = {"forecast": FORECAST_SCHEMA, "base_prediction": BASE_PREDICTION_SCHEMA, "metric": METRIC_SCHEMA}


def _is_path(target: str) -> bool:
    return "/" in target or target.endswith(".parquet")


def append(df: DataFrame, target: str, partition_by=None) -> bool:
    """SNK-1: append rows; an empty frame is skipped. Returns whether anything was written."""
    if _is_path(target):
        recover(df.sparkSession, target)
    if df.isEmpty():
        return False
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if _is_path(target):
        w.parquet(target)
    else:
        w.saveAsTable(target)
    return True


class _Folder:
    """A table's folder in its Hadoop file system."""

    def __init__(self, spark: SparkSession, target: str):
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.root = self.hadoop.Path(target)
        self.fs = self.root.getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, inside: str):
        return self.hadoop.Path(self.root, inside) if inside else self.root

    def names(self, prefix: str) -> list[str]:
        if not self.fs.exists(self.root):
            return []
        return [n for st in self.fs.listStatus(self.root) if (n := st.getPath().getName()).startswith(prefix)]

    def files(self, inside: str) -> list[str]:
        """Data files below a folder, by their path in it."""
        folder, out = self.path(inside), []
        if self.fs.exists(folder):
            whole = self.fs.makeQualified(folder).toUri().getPath()
            found = self.fs.listFiles(folder, True)
            while found.hasNext():
                path = found.next().getPath()
                if path.getName().startswith("part-"):
                    out.append(path.toUri().getPath()[len(whole) + 1 :])
        return out

    def write(self, inside: str, text: str) -> None:
        """A file that is there in full or not at all."""
        out = self.fs.create(self.path(inside + ".tmp"), True)
        out.write(bytearray(text.encode()))
        out.close()
        self.fs.rename(self.path(inside + ".tmp"), self.path(inside))

    def read(self, inside: str) -> str:
        stream = self.fs.open(self.path(inside))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def delete(self, inside: str) -> None:
        self.fs.delete(self.path(inside), True)

    def move(self, a: str, b: str) -> None:
        to = self.path(b)
        self.fs.mkdirs(to.getParent())
        if not self.fs.rename(self.path(a), to):
            raise RuntimeError(f"could not move {a} to {b}")


STAGED, JOURNAL = "_replace-", "_journal-"


def _swap(folder: _Folder, journal: str) -> None:
    """What a journal says: its old files go, its staged files take their places. Each step may have been done before."""
    plan = json.loads(folder.read(journal))
    for old in plan["old"]:
        folder.delete(old)
    for name in folder.files(plan["staged"]):
        folder.move(f"{plan['staged']}/{name}", name)
    folder.delete(plan["staged"])
    folder.delete(journal)


def recover(spark: SparkSession, target: str) -> None:
    """Finish an interrupted ``replace_partition`` of a table by path.

    A journal is complete before the first old file goes: with one, the swap is
    carried out to its end (all new rows); without one, the staged rows are dropped
    (all old rows). ``append`` and ``replace_partition`` call it first; a reader that
    may follow an interrupted writer should too. One writer at a time.
    """
    folder = _Folder(spark, target)
    for name in folder.names(JOURNAL):
        if name.endswith(".tmp"):
            folder.delete(name)
        else:
            _swap(folder, name)
    for name in folder.names(STAGED):
        folder.delete(name)


def replace_partition(spark: SparkSession, df: DataFrame, target: str, keys: dict, partition_by) -> None:
    """SNK-2: remove every row that matches ``keys``, keep all others, insert all rows of ``df`` (none: only remove).

    The table is partitioned by ``partition_by``, which must contain the key
    columns, so the matching rows are whole partitions; a key value None matches
    rows without a value. The new rows are staged inside the table's folder; then a
    journal with the old files is written; only then are the old files deleted and
    the staged ones moved. Whatever interrupts it, the next call (or ``recover``)
    ends with all old or all new rows. An empty key set is an error.
    """
    if not keys:
        raise ValueError("replace_partition needs at least one key")
    missing = set(keys) - set(partition_by)
    if missing:
        raise ValueError(f"keys {sorted(missing)} are not partition columns")
    if not _is_path(target):
        rows = reliable_checkpoint(df)  # it may read the table itself

        def lit(v):
            if v is None:
                return "NULL"
            return str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"

        spec = ", ".join(f"{k} = {lit(v)}" for k, v in keys.items())
        spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({spec})")
        if not rows.isEmpty():
            rows.select(*spark.table(target).columns).write.insertInto(target)
        return
    recover(spark, target)
    folder, name = _Folder(spark, target), uuid.uuid4().hex
    df.write.partitionBy(*partition_by).parquet(f"{target.rstrip('/')}/{STAGED}{name}")
    part = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    wanted = {k: part(k, None if v is None else str(v)) for k, v in keys.items()}

    def matches(file: str) -> bool:
        steps = dict(zip(partition_by, file.split("/")))
        return all(steps.get(k) == v for k, v in wanted.items())

    old = [f for f in folder.files("") if not f.startswith("_") and matches(f)]
    folder.write(JOURNAL + name, json.dumps({"staged": STAGED + name, "old": old}))
    _swap(folder, JOURNAL + name)


def execute(spark: SparkSession, statement: str, params: dict | None = None) -> None:
    """SNK-3: run a statement without a result."""
    spark.sql(statement, args=params or {})


def write_outputs(frames: dict, out_dir: str, fmt: str = "parquet") -> dict:
    """SNK-5 / SNK-6: one output per report frame, as parquet (default) or CSV with a header row.

    Returns {name: path}. Each frame is written by the executors; nothing passes through the driver.
    """
    paths = {}
    for name, df in frames.items():
        if df is None:
            continue
        path = f"{out_dir.rstrip('/')}/{name}"
        w = df.write.mode("overwrite")
        if fmt == "csv":
            w.option("header", True).option("encoding", "UTF-8").csv(path)
        else:
            w.parquet(path)
        paths[name] = path
    return paths


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """SNK-4: project a frame onto an output table schema (casts; absent columns become NULL)."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])


def append_outputs(outputs: dict[str, DataFrame], targets: dict[str, str]) -> list[str]:
    """SNK-4: append a run's forecast, base prediction and metric rows to their tables, in the tables' schemas.

    ``targets`` names the tables to write (a run of the original writes the metric table only). Returns those that got rows.
    """
    unknown = set(targets) - set(OUTPUT_TABLES)
    if unknown:
        raise ValueError(f"no output table {sorted(unknown)}")
    return [name for name, target in targets.items() if append(conform(outputs[name], OUTPUT_TABLES[name]), target)]

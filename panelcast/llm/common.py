"""Helpers shared by the training-data operators: table reads, stored stages, Arrow text access."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.session import ensure_checkpoint_dir

#: A slice of a batch that a vectorised helper works on at once holds about this many text bytes (or one longer text).
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id="doc_id"):
    """Rows that no model may learn from: crc32 of the id's decimal text is divisible by 5 (a null id counts as held out)."""
    c = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(F.pmod(c, F.lit(5)) == 0, F.lit(True))


def text_frame(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more) -> DataFrame:
    """``doc_id`` and ``text`` of a frame, whatever else it holds; a null text becomes empty."""
    return df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *more)


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1, from 0) and bytes of a string or binary Arrow array, without copying the text; nulls are empty."""
    if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = col.buffers()
    if len(col) == 0 or offsets is None:
        return np.zeros(len(col) + 1, np.int64), np.zeros(0, np.uint8)
    at = np.frombuffer(offsets, kind, len(col) + 1, col.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return at - at[0], raw[at[0] : at[-1]]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of a batch that hold about ``most`` text bytes each, one row at least."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def texts(col: pa.Array) -> Iterator[bytes]:
    """The rows of a string array as bytes, one at a time; nulls are empty."""
    at, raw = utf8(col)
    data = memoryview(raw)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        yield bytes(data[a:b])


def with_column(df: DataFrame, name: str, kind: str, values, *reads: str) -> DataFrame:
    """``df`` with one more column, made in an Arrow pass from the columns it ``reads``; all others pass through.

    ``values`` takes the read columns of a batch and returns an Arrow array. A
    column of the same name is replaced.
    """
    kept = df.drop(name)
    at = [kept.columns.index(c) for c in reads]

    def run(batches):
        for batch in batches:
            made = values(*(batch.column(i) for i in at))
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, name])

    return kept.mapInArrow(run, kept.withColumn(name, F.lit(None).cast(kind)).schema)

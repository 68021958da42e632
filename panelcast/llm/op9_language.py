"""Language identification by nearest centroids of TF-IDF n-gram vectors.

A text is lower-cased, ASCII bytes that are no letters become spaces (bytes over 127
all count, so emoji and other signs beyond ASCII do too), and its byte 3-grams are hashed to ``DIMENSIONS`` counts; log(1 + count) times the inverse
document frequency, scaled to length one, is its vector. Each language has
several centroids (spherical k-means); the nearest by cosine gives the language.
A text farther from all centroids than nearly all texts of the predicted
language are from theirs is marked ``rejected``.

Document frequencies come from all rows that may be learned from. Centroids are
fitted on a bounded sample per language (``SAMPLE``), each language in a task of
its own.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
so is every text when there is nothing to learn from; rows with a null language
or id teach nothing; repeated rows are judged each; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import held_out, slices, utf8

DIMENSIONS = 4096
#: Documents per language that centroids are fitted on (about; chosen by a hash of the id), centroids per language.
SAMPLE, CENTROIDS, ROUNDS = 600, 4, 12
#: Share of a language's sample that may lie beyond its distance of rejection.
REJECTED = 0.002
UNKNOWN = "und"

_LETTER = np.full(256, 32, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def counts(at: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Hashed 3-gram counts (texts x ``DIMENSIONS``); every text stands between two spaces."""
    n = len(at) - 1
    spaced = np.append(np.insert(_LETTER[data], at[:-1], 32), 32).astype(np.uint32)
    gram = (spaced[:-2] << 16 | spaced[1:-1] << 8 | spaced[2:]) if len(spaced) > 2 else np.zeros(0, np.uint32)
    code = ((gram * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int64)
    text = np.repeat(np.arange(n), np.diff(at) + 1)[: len(gram)]
    last = at[1:] + np.arange(1, n + 1) - 1  # a gram from here would take in the next text
    use = (spaced[1:-1] != 32) | ((spaced[:-2] != 32) & (spaced[2:] != 32))
    use[last[last < len(use)]] = False
    return np.bincount(text[use] * DIMENSIONS + code[use], minlength=n * DIMENSIONS).reshape(n, DIMENSIONS)


def count_blocks(col: pa.Array):
    """First row and counts of the batch's rows, a bounded block at a time."""
    at, data = utf8(pc.utf8_lower(col))
    for a, b in slices(at, 1 << 20):
        for i in range(a, b, 128):
            j = min(b, i + 128)
            yield i, counts(at[i : j + 1] - at[i], data[at[i] : at[j]])


def vectors(c: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(c.astype(np.float32)) * idf
    return x / np.maximum(1e-12, np.sqrt((x * x).sum(1, keepdims=True)))


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that each dimension occurs in, and their number, over all rows (one bounded row of sums per task and dimension)."""

    def run(batches):
        total, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for _, c in count_blocks(batch.column("text")):
                total += (c > 0).sum(0)
                n += len(c)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, DIMENSIONS)), pa.array(np.append([n], total))], ["dim", "df"])

    got = rows.select("text").mapInArrow(run, "dim long, df long").groupBy("dim").agg(F.sum("df").alias("df")).toPandas()
    out = np.zeros(DIMENSIONS + 1, np.int64)
    out[got["dim"].to_numpy() + 1] = got["df"].to_numpy()
    return out[1:], int(out[0])


def clusters(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means: unit centroids; starts at the mean's nearest row, then rows far from what is chosen."""
    mean = x.mean(0)
    chosen = [int(np.argmax(x @ mean))]
    near = x @ x[chosen[0]]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[chosen[-1]])
    centre = x[chosen]
    for _ in range(rounds):
        own = np.argmax(x @ centre.T, 1)
        sums = np.stack([x[own == j].sum(0) if (own == j).any() else centre[j] for j in range(len(centre))])
        centre = sums / np.maximum(1e-12, np.linalg.norm(sums, axis=1, keepdims=True))
    return centre


class Model:
    def __init__(self, languages: list[str], centroids: np.ndarray, nearest: np.ndarray, idf: np.ndarray):
        self.languages, self.centroids, self.nearest, self.idf = languages, centroids, nearest, idf

    def predict(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid and its cosine, per row."""
        best, cosine = np.zeros(len(col), np.int64), np.zeros(len(col))
        for i, c in count_blocks(col):
            near = vectors(c, self.idf) @ self.centroids.T
            best[i : i + len(c)] = near.argmax(1)
            cosine[i : i + len(c)] = near.max(1)
        return best, np.clip(cosine, 0, 1)


def learn(docs: DataFrame, sample: int = SAMPLE, k: int = CENTROIDS) -> Model | None:
    """Centroids from the rows with a language that are not held out."""
    rows = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & F.col("doc_id").isNotNull() & ~held_out()
    )
    df, n = document_frequencies(rows)
    if not n:
        return None
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    # about `sample` rows of each language, however many rows it has
    share = rows.groupBy("lang").agg(F.count("*").alias("n")).select(F.col("lang").alias("__lang"), F.least(F.lit(1.0), F.lit(sample) / F.col("n")).alias("__share"))
    drawn = rows.join(F.broadcast(share), F.col("lang") == F.col("__lang")).where(
        F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.col("__share") * (1 << 20)
    ).select("lang", "text")

    def run(batches):
        for batch in batches:
            made = [v.tobytes() for _, c in count_blocks(batch.column("text")) for v in vectors(c, idf).astype(np.float16)]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(made, pa.binary())], ["lang", "x"])

    def group(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.stack([np.frombuffer(b, np.float16) for b in sorted(rows["x"])]).astype(np.float32)
        c = clusters(x, k)
        far = float(np.quantile((x @ c.T).max(1), REJECTED))
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "centre": [v.astype(np.float32).tobytes() for v in c], "nearest": far})

    got = drawn.mapInArrow(run, "lang string, x binary").groupBy("lang").applyInPandas(group, "lang string, centre binary, nearest double")
    got = got.orderBy("lang", "centre").collect()
    if not got:
        return None
    return Model([r["lang"] for r in got], np.stack([np.frombuffer(r["centre"], np.float32) for r in got]), np.array([r["nearest"] for r in got]), idf)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` of every row."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    lettered = F.col("text").rlike(r"\p{L}")
    if model is None:
        return rows.select("doc_id", held_out().alias("held_out"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        m = shared.value
        for batch in batches:
            best, cosine = m.predict(batch.column("text"))
            lettered = batch.column("lettered").to_numpy(zero_copy_only=False)
            lang = [m.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(np.where(lettered, cosine, 0.0)), pa.array(~lettered | (cosine < m.nearest[best]))],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    out = rows.select("*", lettered.alias("lettered")).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")

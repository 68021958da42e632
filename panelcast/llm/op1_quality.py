"""Quality classifier: a linear-chain conditional random field over the lines of a text.

Each line is good or bad. Its features are what it is made of (shares of letters,
capitals, digits, marks; word lengths; words and lines said again) and the same
of the line before and the line after. The chain adds weights for keeping or
changing the label from line to line. Forward-backward gives each line's
probability of being good; their mean weighted by line length is the document's
score.

Training labels only exist for documents; line labels are hidden. A document is taken to
be good when its score, the good share of its length, is above ``THRESHOLD``, with a
logistic chance around it (``SHARP``): a rejected document may hold good lines and an
accepted one bad lines. The field is fitted on a bounded sample of labelled rows
(``SAMPLE``) by gradient ascent on the likelihood of the documents' labels. The slope of
a score is the score times the difference of what is expected of a text of which a line
drawn in proportion to length is good and of any text: forward-backward over labels and
whether the line was drawn yet. Every text is then scored whole.

Defined results: a null or empty text is one empty line and gets the score of
one; rows with a null label or id teach nothing; with no label, or only one kind
of label, every score is the share of label 1 (0.5 without labels); repeated rows
are scored each; an empty table gives no rows; other columns pass through
``with_score`` untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.anchors import span_hashes
from panelcast.llm.common import held_out, slices, utf8, with_column

#: Labelled documents that the field is fitted on, at most (about; chosen by a hash of the id).
SAMPLE = 4_000
#: Scores from here on count as good.
THRESHOLD = 0.3
ITERATIONS, RATE, PENALTY = 200, 0.1, 1e-4
#: How steeply the chance of a good document rises with its score at the threshold.
SHARP = 10.0

#: Classes of bytes: other, space, line end, lower case, upper case, digit, sentence mark, bar, exclamation, beyond ASCII.
_CLASSES = 10
_CLASS = np.zeros(256, np.int64)
for _members, _number in ((b" \t\r\x0b\x0c", 1), (b"\n", 2), (bytes(range(97, 123)), 3), (bytes(range(65, 91)), 4), (b"0123456789", 5), (b".,;:?'\"-()", 6), (b"|", 7), (b"!", 8), (bytes(range(128, 256)), 9)):
    _CLASS[list(_members)] = _number
FEATURES = 14


def lines_of(at: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each line, with the end of the data at last, and the first line of each text, with their number at last."""
    breaks = np.flatnonzero(data == 10)
    owner = np.searchsorted(at, breaks, "right") - 1
    starts = np.concatenate([at[:-1], breaks + 1])
    texts = np.concatenate([np.arange(len(at) - 1), owner])
    order = np.lexsort((starts, texts))
    first = np.searchsorted(texts[order], np.arange(len(at)))
    return np.append(starts[order], at[-1]), first


def line_features(at: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features (lines x ``FEATURES``), weights of the lines, first line of each text (with the number of lines at last)."""
    starts, first = lines_of(at, data)
    n = len(starts) - 1
    size = np.diff(starts)
    line = np.repeat(np.arange(n), size)
    counts = np.bincount(line * _CLASSES + _CLASS[data], minlength=n * _CLASSES).reshape(n, _CLASSES).astype(np.float64)
    white = np.concatenate([[True], np.isin(_CLASS[data], (1, 2)), [True]])
    border = np.zeros(len(data) + 1, bool)
    border[starts] = True  # a text may end without a line end
    begin = np.flatnonzero(~white[1:-1] & (white[:-2] | border[:-1]))
    end = np.flatnonzero(~white[1:-1] & (white[2:] | border[1:])) + 1
    words = np.zeros(n)
    again, near = np.zeros(n), np.zeros(n)
    if len(begin):
        h, own = span_hashes(data, begin, end), line[begin]
        words = np.bincount(own, minlength=n).astype(np.float64)
        again = np.bincount(own[1:], (h[1:] == h[:-1]) & (own[1:] == own[:-1]), n)
        order = np.lexsort((h, own))
        ho, oo = h[order], own[order]
        near = np.bincount(oo[1:], (ho[1:] == ho[:-1]) & (oo[1:] == oo[:-1]), n)
    full = np.flatnonzero(size > 0)
    told = np.zeros(n)
    if len(full):
        h, doc = span_hashes(data, starts[full], starts[full] + size[full] - counts[full, 2].astype(int)), np.searchsorted(first, full, "right")
        order = np.lexsort((h, doc))
        same = (h[order][1:] == h[order][:-1]) & (doc[order][1:] == doc[order][:-1])
        told[full[order[1:][same]]] = told[full[order[:-1][same]]] = 1
    shown = np.maximum(1, size - counts[:, 1] - counts[:, 2])
    letters = counts[:, 3] + counts[:, 4] + counts[:, 9]
    some = np.maximum(1, words)
    out = np.stack([
        np.log1p(size), letters / shown, counts[:, 4] / np.maximum(1, letters), counts[:, 5] / shown, counts[:, 6] / shown,
        counts[:, 7] / shown, counts[:, 8] / shown, counts[:, 0] / shown, counts[:, 9] / shown,
        shown / some / 10, again / some, near / some, told, (size - counts[:, 2] == 0),
    ], 1)
    return out.astype(np.float32), size - counts[:, 2] + 1, first


def with_neighbours(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each line's own features, those of the line before and after (zeros at an end of a text), and the two ends."""
    n, k = x.shape
    out = np.zeros((n, 3 * k + 3), np.float32)
    out[:, :k] = x
    out[1:, k : 2 * k] = x[:-1]
    out[:-1, 2 * k : 3 * k] = x[1:]
    head, tail = first[:-1], first[1:] - 1
    out[head, k : 2 * k] = 0
    out[tail, 2 * k : 3 * k] = 0
    out[head, 3 * k] = out[tail, 3 * k + 1] = 1
    out[:, 3 * k + 2] = 1
    return out


def forward_backward(odds: np.ndarray, change: np.ndarray, first: np.ndarray, pairs: bool = False):
    """Probability that each line is good, given its log odds and the log weights ``change`` [from, to];
    with ``pairs`` also the expected number of each change and the log normaliser."""
    p = np.empty((len(odds), 2))
    p[:, 1] = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
    p[:, 0] = 1 - p[:, 1]
    a = np.exp(change - change.max())
    count = np.diff(first)
    order = np.argsort(-count, kind="stable")
    start, count = first[:-1][order], count[order]
    longest = int(count[0]) if len(count) else 0
    active = np.searchsorted(-count, -np.arange(longest + 1), "left")  # texts with more than t lines
    alpha, beta, scale = np.empty_like(p), np.ones_like(p), np.empty(len(p))
    for t in range(longest):
        at = start[: active[t]] + t
        now = p[at] if t == 0 else (alpha[at - 1] @ a) * p[at]
        scale[at] = now.sum(1)
        alpha[at] = now / scale[at, None]
    for t in range(longest - 2, -1, -1):
        at = start[: active[t + 1]] + t
        now = (p[at + 1] * beta[at + 1]) @ a.T
        beta[at] = now / now.sum(1, keepdims=True)
    both = alpha * beta
    good = both[:, 1] / both.sum(1)
    if not pairs:
        return good
    inner = np.ones(len(odds), bool)
    inner[first[:-1]] = False
    to = np.flatnonzero(inner)
    joint = alpha[to - 1][:, :, None] * a[None] * (p[to] * beta[to])[:, None, :]
    joint /= joint.sum((1, 2), keepdims=True)
    return good, joint.sum(0), to


def given_drawn(odds: np.ndarray, change: np.ndarray, first: np.ndarray, share: np.ndarray):
    """Each text's chance that a line drawn with chance ``share`` (sums to 1 over a text) is good, which is its score; each
    line's probability of being good given that and without it; the same two of each change from the line before (with
    the lines ``to`` that have one). Chains are summed over without a drawn line so far (0) and with one (1)."""
    p = np.empty((len(odds), 2))
    p[:, 1] = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
    p[:, 0] = 1 - p[:, 1]
    a = np.exp(change - change.max())
    count = np.diff(first)
    drawn = np.stack([np.zeros(len(odds)), share], 1)
    order = np.argsort(-count, kind="stable")
    start, count = first[:-1][order], count[order]
    longest = int(count[0]) if len(count) else 0
    active = np.searchsorted(-count, -np.arange(longest + 1), "left")  # texts with more than t lines
    alpha = np.empty((2, len(odds), 2))
    beta = np.stack([np.zeros_like(p), np.ones_like(p)])
    scale = np.empty(len(p))
    for t in range(longest):
        at = start[: active[t]] + t
        none, one = (p[at], 0.0) if t == 0 else ((alpha[0, at - 1] @ a) * p[at], (alpha[1, at - 1] @ a) * p[at])
        scale[at] = none.sum(1)
        alpha[0, at] = none / scale[at, None]
        alpha[1, at] = (one + none * drawn[at]) / scale[at, None]
    for t in range(longest - 2, -1, -1):
        at = start[: active[t + 1]] + t + 1
        to = p[at] / scale[at, None]
        beta[1, at - 1] = (to * beta[1, at]) @ a.T
        beta[0, at - 1] = (to * (beta[0, at] + drawn[at] * beta[1, at])) @ a.T
    both, plain = (alpha * beta).sum(0), alpha[0] * beta[1]
    chance = (both.sum(1) / plain.sum(1))[first[:-1]]
    inner = np.ones(len(odds), bool)
    inner[first[:-1]] = False
    to = np.flatnonzero(inner)
    none, one = alpha[0, to - 1][:, :, None] * a, alpha[1, to - 1][:, :, None] * a
    ahead = (p[to] * beta[1, to])[:, None, :]
    pairs = [none * (p[to] * (beta[0, to] + drawn[to] * beta[1, to]))[:, None, :] + one * ahead, none * ahead]
    return chance, *(g[:, 1] / g.sum(1) for g in (both, plain)), *(j / j.sum((1, 2), keepdims=True) for j in pairs), to


class Field:
    """A fitted field; without weights it says ``share`` for every line."""

    def __init__(self, share: float, weights=None, change=None, mean=None, spread=None):
        self.share, self.weights, self.change, self.mean, self.spread = share, weights, change, mean, spread

    def line_probabilities(self, at: np.ndarray, data: np.ndarray):
        x, weight, first = line_features(at, data)
        if self.weights is None:
            return np.full(len(x), self.share), weight, first
        x = with_neighbours((x - self.mean) / self.spread, first)
        return forward_backward(x @ self.weights, self.change, first), weight, first

    def scores(self, at: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Length-weighted mean of the lines' probabilities, per text."""
        good, weight, first = self.line_probabilities(at, data)
        return np.add.reduceat(good * weight, first[:-1]) / np.add.reduceat(weight, first[:-1])


def fit(features: list[np.ndarray], lengths: list[np.ndarray], labels: list[int]) -> Field:
    """Field from the line features and line lengths of labelled texts: maximum likelihood of the labels, by Adam."""
    share = float(np.mean(labels)) if labels else 0.5
    if len(set(labels)) < 2:
        return Field(share)
    first = np.concatenate([[0], np.cumsum([len(x) for x in features])])
    x = np.concatenate(features)
    mean, spread = x.mean(0), x.std(0) + 1e-3
    x = with_neighbours((x - mean) / spread, first)
    drawn = np.concatenate([w / w.sum() for w in lengths])
    y = np.asarray(labels, np.float64)
    weights, change = np.zeros(x.shape[1]), np.zeros((2, 2))
    moments = [np.zeros(len(weights) + 4), np.zeros(len(weights) + 4)]
    for step in range(1, ITERATIONS + 1):
        score, given, any_, given_pairs, any_pairs, to = given_drawn(x @ weights, change, first, drawn)
        pull = (y - 1 / (1 + np.exp(-SHARP * (score - THRESHOLD)))) * SHARP * score
        pull = np.repeat(pull, np.diff(first))
        slope = np.concatenate([((given - any_) * pull) @ x, np.tensordot(pull[to], given_pairs - any_pairs, 1).ravel()]) / len(labels)
        slope -= PENALTY * np.concatenate([weights, change.ravel()])
        moments[0] += 0.1 * (slope - moments[0])
        moments[1] += 0.01 * (slope**2 - moments[1])
        move = RATE * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        weights += move[:-4]
        change += move[-4:].reshape(2, 2)
    return Field(share, weights, change, mean, spread)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field:
    """Fit on about ``sample`` rows (never many more) of ``labels`` (doc_id, quality) that are not held out."""
    usable = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where(
        F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()
    )
    n = usable.count()
    if not n:
        return fit([], [], [])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, sample / n))
    drawn = usable.where(draw).limit(2 * sample).select(F.col("doc_id").alias("__id"), F.col("quality").alias("__label"))
    texts = docs.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("__id")).select("doc_id", "text", "__label")

    def run(batches):
        for batch in batches:
            at, data = utf8(batch.column("text"))
            x, weight, first = line_features(at, data)
            x = np.column_stack([x, weight]).astype(np.float32)
            rows = [x[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("__label"), pa.array(rows, pa.binary())], ["doc_id", "label", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    got = texts.mapInArrow(run, f"doc_id {kind}, label int, x binary").orderBy("doc_id", "label", "x").toArrow()
    rows = [np.frombuffer(b, np.float32).reshape(-1, FEATURES + 1) for b in got.column("x").to_pylist()]
    return fit([x[:, :-1] for x in rows], [x[:, -1].astype(np.float64) for x in rows], got.column("label").to_pylist())


def with_score(docs: DataFrame, field: Field, name: str = "score") -> DataFrame:
    """``docs`` and each text's quality."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def values(col):
        at, data = utf8(col)
        out = [shared.value.scores(at[a : b + 1] - at[a], data[at[a] : at[b]]) for a, b in slices(at, 1 << 20)]
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return with_column(docs, name, "double", values, "text")


def label_lines(docs: DataFrame, field: Field) -> DataFrame:
    """Every line with its probability of being good: ``doc_id, line, good``."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches):
        for batch in batches:
            at, data = utf8(batch.column("text"))
            for a, b in slices(at, 1 << 20):
                good, _, first = shared.value.line_probabilities(at[a : b + 1] - at[a], data[at[a] : at[b]])
                count = np.diff(first)
                ids = batch.column("doc_id").take(pa.array(np.repeat(np.arange(a, b), count)))
                number = np.arange(len(good)) - np.repeat(first[:-1], count)
                yield pa.RecordBatch.from_arrays([ids, pa.array(number), pa.array(good)], ["doc_id", "line", "good"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, line long, good double")


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The contract's rows: ``doc_id, held_out, score, predicted``."""
    scored = with_score(docs.select("doc_id", "text"), learn(docs, labels, sample))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, field: Field) -> DataFrame:
    """The rows of ``docs`` that the field accepts."""
    return with_score(docs, field, "__quality").where(F.col("__quality") >= THRESHOLD).select(*docs.columns)

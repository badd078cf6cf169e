"""Quality classifier by positive-unlabelled learning.

Trusted positives are labelled rows of good quality; unlabelled text is the whole corpus. The model is linear
in a fixed set of text features, under the squared loss, so every term of the non-negative unbiased risk

    prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)])

is a quadratic form in first and second moments. Spark sums those moments over all positives and all documents
in one pass over written features; the driver sees matrices of (features + 1) squared and minimises the risk by
gradient steps: where the negative part falls below zero, the step goes up that part instead. The class prior
comes from the same data: a positive-against-unlabelled score is tallied over both sets, and the prior is the
smallest ratio of upper tails, which holds for every region of the score.

Cases: null and empty texts have zero features and a score; repeated rows count as often as they stand; a
document with contradicting labels is no trusted positive; rows with a null id are never labelled. Without
positives or documents the score is 0.5 for every row. Extra columns stay; one with the name of a result
column is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountrisk.llm.common import as_bytes, list_array, steps, trimmed
from accountrisk.session import written

_SYMBOLS = [b for b in range(0x21, 0x7F) if not chr(b).isalnum()]
_CLASS = np.zeros(256, np.int64)  # symbols have a class each, then upper, lower, digit, line feed, space, control, other
for _k, _b in enumerate(_SYMBOLS):
    _CLASS[_b] = _k
_UPPER = len(_SYMBOLS)
_CLASS[0x41:0x5B], _CLASS[0x61:0x7B], _CLASS[0x30:0x3A] = _UPPER, _UPPER + 1, _UPPER + 2
_CLASS[:0x20] = _UPPER + 5
_CLASS[0x0A], _CLASS[0x20], _CLASS[0x7F] = _UPPER + 3, _UPPER + 4, _UPPER + 5
_CLASS[0x80:] = _UPPER + 6
N_CLASSES = _UPPER + 7
N_STATS = 8
N_FEATURES = 2 * N_CLASSES + N_STATS
#: Scales of the squashing of byte shares: tanh(share * scale). Two of them make the response piecewise.
SCALES = (8.0, 60.0)
BINS = 400
RIDGE = 1e-3
STEPS = 3_000
#: Text bytes worked on at once.
STEP = 1_000_000


def features(texts: list[bytes]) -> np.ndarray:
    """One row of N_FEATURES for each text."""
    out = np.zeros((len(texts), N_FEATURES), np.float32)
    if not texts:
        return out
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    raw = np.frombuffer(b"".join(texts), np.uint8)
    owner = np.repeat(np.arange(len(texts)), sizes)
    counts = np.bincount(owner * N_CLASSES + _CLASS[raw], minlength=len(texts) * N_CLASSES).reshape(-1, N_CLASSES)
    shares = counts / np.maximum(sizes, 1)[:, None]
    out[:, :N_CLASSES] = np.tanh(shares * SCALES[0])
    out[:, N_CLASSES : 2 * N_CLASSES] = np.tanh(shares * SCALES[1])
    for row, text in zip(out, texts, strict=True):
        words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
        if not words:
            continue
        n, pairs = len(words), list(zip(words, words[1:], words[2:]))
        row[2 * N_CLASSES :] = (
            np.log1p(n) / 10,
            min(n, 50) / 50,
            np.tanh((len(text) / n - 1) / 12),
            len(set(words)) / n,
            1 - len(set(lines)) / len(lines),
            1 - len(set(pairs)) / len(pairs) if pairs else 0,
            np.tanh(n / len(lines) / 60),
            sum(map(bytes.isupper, words)) / n,
        )
    return out


def feature_table(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """``row_id`` and ``features`` (array of float) of every row."""
    base = docs.select(F.col(id_col).alias("row_id"), as_bytes(text_col).alias("t"))

    def run(batches):
        for batch in batches:
            for part in steps(batch, "t", STEP):
                f = features(part.column("t").to_pylist())
                lists = list_array(f.ravel(), np.arange(part.num_rows + 1) * N_FEATURES)
                yield pa.RecordBatch.from_arrays([part.column("row_id"), lists], ["row_id", "features"])

    return base.mapInArrow(trimmed(run), base.select("row_id", F.lit(None).cast("array<float>").alias("features")).schema)


def matrix_of(column: pa.Array) -> np.ndarray:
    """The feature rows with a last column of ones."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, N_FEATURES)
    return np.hstack([flat, np.ones((len(flat), 1))])


def summed(table: DataFrame, groups: int, tally) -> np.ndarray:
    """Sum over all rows of ``tally(batch)``, a vector for each of ``groups``; partial sums are made in tasks."""

    def run(batches):
        total = None
        for batch in batches:
            own = tally(batch)
            total = own if total is None else total + own
        if total is not None:
            flat = total.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(flat.size)), pa.array(flat)], ["k", "v"])

    rows = table.mapInArrow(trimmed(run), "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(1 + max((r.k for r in rows), default=-1))
    for r in rows:
        out[r.k] = r.v
    return out.reshape(groups, -1) if rows else np.zeros((groups, 0))


def prior_of(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The class prior from the two tallies of scores, low to high.

    For a region A of scores P_U(A) >= prior * P_P(A). The regions are upper tails that hold at least half of the
    positives; each ratio is raised by what chance may have taken from it.
    """
    p, u = positive[::-1].cumsum() / positive.sum(), unlabelled[::-1].cumsum() / unlabelled.sum()
    slack = 2 * np.sqrt(p * (1 - p) / positive.sum() + u * (1 - u) / unlabelled.sum())
    ratio = (u + slack) / np.maximum(p, 1e-9)
    return float(np.clip(ratio[p >= 0.5].min(), 0.02, 0.98))


def minimised(moment_p: np.ndarray, moment_u: np.ndarray, prior: float) -> np.ndarray:
    """Weights with the least non-negative risk; moments are means of outer products, ones in the last column."""
    d = len(moment_u)
    mean_p, mean_u = moment_p[-1], moment_u[-1]
    ridge = RIDGE * np.eye(d)
    ridge[-1, -1] = 0
    ahead = np.linalg.inv(moment_u + prior * moment_p + 0.01 * np.eye(d))
    w, best, least = np.zeros(d), np.zeros(d), np.inf
    for k in range(STEPS):
        negative = (1 + 2 * w @ mean_u + w @ moment_u @ w) / 4 - prior * (1 + 2 * w @ mean_p + w @ moment_p @ w) / 4
        risk = prior * (1 - 2 * w @ mean_p + w @ moment_p @ w) / 4 + max(0.0, negative) + w @ ridge @ w
        if risk < least:
            least, best = risk, w
        down = (mean_u + moment_u @ w) / 2 - prior * (mean_p + moment_p @ w) / 2
        if negative >= 0:
            step = prior * (moment_p @ w - mean_p) / 2 + down + 2 * ridge @ w
        else:
            step = -down
        w = w - 0.5 / (1 + k / 300) * ahead @ step
    return best


class PuModel:
    """Weights over the features, ones last, and the class prior they were fitted with."""

    def __init__(self, weights: np.ndarray, prior: float):
        self.weights, self.prior = weights, prior

    def score(self, rows: np.ndarray) -> np.ndarray:
        # under the squared loss g estimates 2 p - 1
        return np.clip((rows @ self.weights + 1) / 2, 0.0, 1.0)


def fit(table: DataFrame) -> PuModel:
    """``table``: features and trusted (boolean) of all documents."""

    def moments(batch):
        x = matrix_of(batch.column("features"))
        p = x[batch.column("trusted").to_numpy(zero_copy_only=False).astype(bool)]
        return np.stack([np.append(p.T @ p, len(p)), np.append(x.T @ x, len(x))])

    sums = summed(table.select("features", "trusted"), 2, moments)
    d = N_FEATURES + 1
    if not sums.size or not sums[0, -1]:
        return PuModel(np.zeros(d), 0.5)
    moment_p, moment_u = ((s[:-1] / s[-1]).reshape(d, d) for s in sums)
    # positives against unlabelled, each half the weight: its score orders rows for the prior's tallies
    side = np.linalg.solve(moment_p + moment_u + RIDGE * np.eye(d), moment_p[-1] - moment_u[-1])

    def tallies(batch):
        g = matrix_of(batch.column("features")) @ side
        bins = np.clip((np.tanh(g) + 1) / 2 * BINS, 0, BINS - 1).astype(np.int64)
        trusted = batch.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
        return np.stack([np.bincount(bins[trusted], minlength=BINS), np.bincount(bins, minlength=BINS)]).astype(float)

    prior = prior_of(*summed(table.select("features", "trusted"), 2, tallies))
    return PuModel(minimised(moment_p, moment_u, prior), prior)


def is_held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """``docs`` with ``held_out``, ``score`` (0 to 1, higher is better) and ``predicted`` (score >= 0.5).

    Labels of held-out rows (crc32 of the id as text, mod 3 is 1) are never used; ids, languages, sources and
    labels are no inputs of a score. The features are written once for fitting, without the texts; scoring is a
    pass over the texts that shuffles nothing.
    """
    model = fit_quality(docs, labels, id_col, text_col, label_col)
    weights = docs.sparkSession.sparkContext.broadcast(model)
    base = docs.drop("held_out", "score", "predicted").withColumn(text_col, F.col(text_col).cast("string"))
    at = base.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for part in steps(batch, batch.schema.names[at], STEP):
                texts = [t or b"" for t in part.column(at).cast(pa.binary()).to_pylist()]
                x = features(texts).astype(np.float64)
                s = weights.value.score(np.hstack([x, np.ones((len(x), 1))]))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s)], [*part.schema.names, "score"])

    scored = base.mapInArrow(trimmed(run), base.withColumn("score", F.lit(None).cast("double")).schema)
    return scored.withColumn("held_out", is_held_out(id_col)).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> PuModel:
    """The model from all rows of ``docs`` and the labels that are not held out."""
    table = written(feature_table(docs, text_col, id_col), "pu-features")
    labelled = labels.where(F.col(label_col).isNotNull() & ~is_held_out(id_col)).groupBy(F.col(id_col).alias("label_id"))
    trusted = labelled.agg(F.min(label_col).alias("low"), F.max(label_col).alias("high")).where("low = 1 AND high = 1")
    joined = table.join(trusted, F.col("row_id") == F.col("label_id"), "left")
    return fit(joined.select("features", F.col("label_id").isNotNull().alias("trusted")))

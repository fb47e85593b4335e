"""Quality classifier by positive-unlabelled learning.

Trusted positives are the labelled rows of quality 1 outside the held-out fold; the unlabelled set
is all text outside it, the positives among it included. With the logistic loss the unbiased risk

    R(g) = prior * E_p[l(g)] + max(0, E_u[l(-g)] - prior * E_p[l(-g)])

is convex where the maximum is not at zero, so damped Newton steps minimise it over a few dozen
text statistics; a step after which the unlabelled part falls below zero is shortened, and training
stops where none helps. Every step is one pass of a Spark job over the written statistics of all
rows; what reaches the driver are sums whose size depends on the number of statistics only.

The class prior is the share of quality 1 among the labelled rows outside the held-out fold, unless
one is given. Labels, language, source and doc_id are no inputs of a score.

NULL text counts as empty and gets a score like any other. A row without a doc_id has no label and
is not held out. Labels that are NULL or contradict each other are left out. With no positives the
score is the prior (0.5 where there is none either). An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flowlake.llm.common import SPACES, word_hashes, written

FOLDS = 3
HELD_OUT = 1
RIDGE = 1e-3
STEPS = 25
# Unlabelled risk may be this far below zero before a step is shortened.
SLACK = 1e-3

_BYTES = {
    "pipe": b"|", "symbol": b"#$%&*+<=>@\\^_`{}~", "stop": b".!?", "comma": b",;:",
    "quote": b"\"'", "bracket": b"()[]/", "digit": b"0123456789", "dash": b"-",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "line": b"\n",
}
_CLASSES = np.zeros((256, len(_BYTES) + 1))
for _i, _set in enumerate(_BYTES.values()):
    _CLASSES[list(_set), _i] = 1
_CLASSES[128:, len(_BYTES)] = 1
N_STATS = _CLASSES.shape[1] + 13
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True


def _word_lengths(raw: np.ndarray) -> np.ndarray:
    cuts = np.concatenate(([-1], np.flatnonzero(_IS_SPACE[raw]), [len(raw)]))
    lengths = np.diff(cuts) - 1
    return lengths[lengths > 0]


def statistics(text: str | None) -> np.ndarray:
    """Statistics of one whole text."""
    out = np.zeros(N_STATS)
    data = (text or "").encode("utf-8", "surrogatepass")
    words = word_hashes(text or "")
    n = len(words)
    if not n:
        out[-1] = 1
        return out
    raw = np.frombuffer(data, np.uint8)
    k = _CLASSES.shape[1]
    # Square roots spread the small shares.
    out[:k] = np.sqrt(np.bincount(raw, minlength=256) @ _CLASSES / len(raw))
    lengths = _word_lengths(raw)
    counts = np.unique(words, return_counts=True)[1]
    lines = [line for line in data.split(b"\n") if line.strip()]
    pairs = words[1:] * np.uint64(3) + words[:-1]
    out[k:-1] = (
        np.log1p(n),
        np.log(lengths.mean()),
        np.log1p(lengths.std()),
        np.log1p(lengths.max()),
        (lengths <= 3).mean(),
        (lengths >= 12).mean(),
        np.log1p(len(counts)) / np.log1p(n),
        np.sqrt(counts.max() / n),
        (counts == 1).sum() / n,
        (words[1:] == words[:-1]).mean() if n > 1 else 0.0,
        len(np.unique(pairs)) / max(1, n - 1) if n > 1 else 1.0,
        len(set(lines)) / len(lines),
    )
    return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def _design(stats: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Standardised statistics with a kink at one deviation to each side, and a constant."""
    z = np.clip((stats - mean) / spread, -8, 8)
    return np.hstack([z, np.maximum(z - 1, 0), np.maximum(-1 - z, 0), np.ones((len(z), 1))])


def _sigmoid(g: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(g / 2))


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    prior: float

    def scores(self, stats: np.ndarray) -> np.ndarray:
        return _sigmoid(_design(stats, self.mean, self.spread) @ self.weights)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, held_out and the statistics of every row, written."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = [statistics(t) for t in batch.column(2).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(stats, pa.list_(pa.float64()))],
                names=["doc_id", "held_out", "stats"],
            )

    rows = docs.select(docs["doc_id"].alias("doc_id"), held_out(docs["doc_id"]).alias("held_out"), docs["text"])
    return written(rows.mapInArrow(measure, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, stats array<double>"), "quality-stats")


def _summed(rows: DataFrame, part, n: int) -> np.ndarray:
    """Sums over all rows of the ``n`` numbers that ``part`` makes of a batch; added up in Spark."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n)
        for batch in batches:
            if batch.num_rows:
                stats = np.array(batch.column("stats").flatten()).reshape(batch.num_rows, -1)
                total += part(stats, np.array(batch.column("positive"), bool))
        yield pa.record_batch([pa.array([total], pa.list_(pa.float64()))], names=["sums"])

    sums = (
        rows.mapInArrow(partial, "sums array<double>").select(F.posexplode("sums").alias("i", "x"))
        .groupBy("i").agg(F.sum("x").alias("x")).collect()
    )
    out = np.zeros(n)
    for row in sums:
        out[row.i] = row.x
    return out


def fit(stats: DataFrame, labels: DataFrame, prior: float | None = None) -> Model:
    """Train on the rows of ``stats`` outside the held-out fold."""
    known = (
        labels.select(labels["doc_id"].alias("doc_id"), labels["quality"].alias("quality"))
        .filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
        .filter("low = high").select("doc_id", F.col("low").alias("quality"))
    )
    rows = written(
        stats.filter("NOT held_out").join(known, "doc_id", "left")
        .select("stats", "quality", F.coalesce(F.col("quality") == 1, F.lit(False)).alias("positive")),
        "quality-rows",
    )
    seen = rows.agg(F.count("quality").alias("labelled"), F.count_if("positive").alias("positive")).first()
    if prior is None:
        prior = seen.positive / seen.labelled if seen.labelled else 0.5
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    rows = rows.select("stats", "positive")

    def moments(x: np.ndarray, _: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])

    total = _summed(rows, moments, 1 + 2 * N_STATS)
    n = max(1.0, total[0])
    mean = total[1 : N_STATS + 1] / n
    spread = np.sqrt(np.maximum(total[N_STATS + 1 :] / n - mean**2, 0))
    spread[spread < 1e-9] = 1.0
    size = 3 * N_STATS + 1
    weights = np.zeros(size)
    weights[-1] = np.log(prior / (1 - prior))
    if not seen.positive or n <= seen.positive:
        return Model(mean, spread, weights, prior)

    def risk(w: np.ndarray):
        """(risk, unlabelled part, gradient, curvature) at ``w``."""

        def part(stats: np.ndarray, positive: np.ndarray) -> np.ndarray:
            x = _design(stats, mean, spread)
            g = x @ w
            s, loss = _sigmoid(g), np.logaddexp(0, -g)
            return np.concatenate([
                [loss[positive].sum(), (loss + g)[positive].sum(), (loss + g).sum()],
                x[positive].sum(0), s @ x, ((x * (s * (1 - s))[:, None]).T @ x).ravel(),
            ])

        t = _summed(rows, part, 3 + 2 * size + size * size)
        p = float(seen.positive)
        below = t[2] / n - prior * t[1] / p
        ridge = RIDGE * np.append(w[:-1], 0)
        grad = t[3 + size : 3 + 2 * size] / n - prior * t[3 : 3 + size] / p + ridge
        hess = t[3 + 2 * size :].reshape(size, size) / n + RIDGE * np.eye(size)
        value = prior * t[0] / p + max(0.0, below) + RIDGE / 2 * float(w[:-1] @ w[:-1])
        return value, below, grad, hess

    value, below, grad, hess = risk(weights)
    for _ in range(STEPS):
        step, moved = np.linalg.solve(hess, grad), False
        for _ in range(6):
            tried = risk(weights - step)
            if tried[1] >= -SLACK and tried[0] < value:
                moved = True
                break
            step = step / 2
        if not moved:
            break
        weights, gain = weights - step, value - tried[0]
        value, below, grad, hess = tried
        if gain < 1e-6:
            break
    return Model(mean, spread, weights, prior)


def score(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every measured row."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("stats").flatten()).reshape(batch.num_rows, N_STATS)
            s = np.clip(model.scores(x), 0, 1)
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    kind = stats.schema["doc_id"].dataType.simpleString()
    return stats.mapInArrow(apply, f"doc_id {kind}, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> DataFrame:
    """Train, then score every row of ``docs``."""
    stats = measured(docs)
    return score(stats, fit(stats, labels, prior))


def accepted(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> DataFrame:
    """The rows of ``docs`` whose score is 0.5 or more, with all their columns."""
    model = fit(measured(docs), labels, prior)

    @F.pandas_udf("double")
    def scored(texts):
        import pandas as pd

        stats = np.array([statistics(t) for t in texts]).reshape(len(texts), N_STATS)
        return pd.Series(model.scores(stats))

    return docs.filter(scored(docs["text"]) >= 0.5)

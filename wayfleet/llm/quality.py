"""Quality classifier: regularised quadratic discriminant on document statistics.

Whole texts become a short vector of transformed statistics. Class means and
covariances come from sums over all labelled rows of the training folds, made
per task and added in Spark. Covariances are shrunk towards the pooled one and
towards a multiple of the identity, their Cholesky factors are computed once
and travel with the scoring function. The score is a squashed difference of log
densities, so far documents keep their order.

Defined results: an empty or null text has the statistics of no words and is
scored like any other; repeated rows are scored one by one; if a class has no
labelled row, every score is that of the other class; further columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfleet.llm import text as texts
from wayfleet.llm.held_out import remainder, sums, training_labels
from wayfleet.session import cut

FOLDS, LEFT_OUT = 3, 1
TO_POOLED, TO_IDENTITY = 0.05, 0.02

_UPPER, _LOWER, _DIGIT, _HIGH, _SPACE, _STOP, _COMMA, _OTHER = range(8)
_KIND = np.full(256, _OTHER, np.int64)
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[128:] = _UPPER, _LOWER, _DIGIT, _HIGH
_KIND[[32, 9, 10, 11, 12, 13]] = _SPACE
_KIND[ord(".")], _KIND[ord(",")] = _STOP, _COMMA
_LINES = np.zeros(256, bool)
_LINES[[10, 13]] = True
NAMES = ("words", "upper", "digits", "high", "space", "stops", "commas", "others", "mean_length", "length_spread",
         "distinct", "echo", "pairs", "lines", "line_words", "longest", "ending")


def _root(x):
    """Angle of a share, which spreads shares near 0 and 1."""
    return np.arcsin(np.sqrt(np.clip(x, 0, 1)))


def statistics(column: pa.Array) -> np.ndarray:
    """One row of statistics for each text."""
    data, at = texts.bytes_of(column)
    out = np.zeros((len(column), len(NAMES)))
    row = 0
    while row < len(column):
        end = min(max(row + 1, int(np.searchsorted(at, at[row] + 2 * texts.PIECE, "right")) - 1), len(column))
        piece, edges = data[at[row]:at[end]], at[row:end + 1] - at[row]
        sizes = np.maximum(np.diff(edges), 1)
        rows = end - row
        kinds = np.bincount(np.repeat(np.arange(rows), np.diff(edges)) * 8 + _KIND[piece], minlength=rows * 8).reshape(rows, 8)
        out[row:end, 1:8] = _root(kinds[:, [_UPPER, _DIGIT, _HIGH, _SPACE, _STOP, _COMMA, _OTHER]] / sizes[:, None])
        part = column.slice(row, rows)
        for kind, separators in (("words", texts.SPACE), ("lines", _LINES)):
            for first, last, hashes, starts in texts.documents(part, separators, 1 << 62):
                for i in range(first, last):
                    h = hashes[starts[i - first]:starts[i - first + 1]]
                    n = max(len(h), 1)
                    if kind == "lines":
                        out[row + i, 13] = _root(len(np.unique(h)) / n) if len(h) else 0
                        out[row + i, 14] = np.log1p(np.expm1(out[row + i, 0]) / n)
                        continue
                    out[row + i, 0] = np.log1p(len(h))
                    if len(h):
                        out[row + i, 10] = _root(len(np.unique(h)) / n)
                        out[row + i, 11] = _root((h[1:] == h[:-1]).mean() if len(h) > 1 else 0)
                        out[row + i, 12] = _root(len(np.unique(h[1:] * np.uint64(31) + h[:-1])) / max(len(h) - 1, 1))
        s, e = texts.words(piece, edges)
        if len(s):
            lengths = (e - s).astype(float)
            who = np.searchsorted(edges, s, "right") - 1
            n = np.maximum(np.bincount(who, minlength=rows), 1)
            mean = np.bincount(who, lengths, rows) / n
            out[row:end, 8] = np.log1p(mean)
            out[row:end, 9] = np.log1p(np.sqrt(np.maximum(np.bincount(who, lengths ** 2, rows) / n - mean ** 2, 0)))
            longest = np.zeros(rows)
            np.maximum.at(longest, who, lengths)
            out[row:end, 15] = np.log1p(longest)
            out[row:end, 16] = _root(np.bincount(who, _KIND[piece[e - 1]] == _OTHER, rows) / n)
        row = end
    return out


def _lists(values: np.ndarray) -> pa.Array:
    width = values.shape[1]
    return pa.ListArray.from_arrays(np.arange(0, values.size + 1, width, dtype=np.int32), pa.array(values.reshape(-1)))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@texts.tidied
def _described(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("id"), _lists(statistics(batch.column("text")))], ["id", "x"])


def _moments(batches):
    """Count, sums and sums of products by class."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        x, label = _matrix(batch.column("x")), batch.column("label").to_numpy()
        for c in np.unique(label):
            own = np.column_stack([np.ones((label == c).sum()), x[label == c]])
            held[int(c)] = held.get(int(c), 0) + own.T @ own
    for c, m in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([m.reshape(-1)])], ["part", "values"])


def fit(moments: dict[int, list[float]], width: int) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """(log prior, mean, inverse Cholesky factor) of each class that has rows."""
    m = {c: np.array(v).reshape(width + 1, width + 1) for c, v in moments.items()}
    total = sum(x[0, 0] for x in m.values())
    means = {c: x[0, 1:] / x[0, 0] for c, x in m.items()}
    own = {c: x[1:, 1:] / x[0, 0] - np.outer(means[c], means[c]) for c, x in m.items()}
    pooled = sum(own[c] * m[c][0, 0] for c in m) / total if m else None
    out = {}
    for c in m:
        near = (1 - TO_POOLED) * own[c] + TO_POOLED * pooled
        near = (1 - TO_IDENTITY) * near + TO_IDENTITY * max(np.trace(pooled) / width, 1e-6) * np.eye(width)
        out[c] = (float(np.log(m[c][0, 0] / total)), means[c], np.linalg.inv(np.linalg.cholesky(near)))
    return out


def log_odds(x: np.ndarray, model: dict[int, tuple[float, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Difference of the log densities and priors of class 1 and class 0."""
    def density(c):
        if c not in model:
            return np.full(len(x), -1e6)
        prior, mean, inverse = model[c]
        return prior + np.log(np.abs(np.diag(inverse))).sum() - 0.5 * (((x - mean) @ inverse.T) ** 2).sum(axis=1)
    return density(1) - density(0)


def squash(odds: np.ndarray) -> np.ndarray:
    """Number in (0, 1), at 0.5 for even odds, that keeps the order of very large odds too."""
    return np.where(odds >= 0, (1 + np.abs(odds)) / (2 + np.abs(odds)), 1 / (2 + np.abs(odds)))


def _scored(model, batches):
    for batch in batches:
        score = squash(log_odds(_matrix(batch.column("x")), model)) if batch.num_rows else np.zeros(0)
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(score)], ["id", "score"])


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(id_col, held_out, score, predicted) of every row of ``docs``."""
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    described = cut(plain.mapInArrow(_described, "id long, x array<double>"), "statistics")
    known = described.join(training_labels(labels, label_col, FOLDS, LEFT_OUT, id_col), "id").select("x", "label")
    model = fit(sums(known, _moments), len(NAMES))
    scored = described.mapInArrow(functools.partial(_scored, model), "id long, score double")
    return scored.select(F.col("id").alias(id_col), (remainder(F.col("id"), FOLDS) == LEFT_OUT).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))

"""Quality by regularised quadratic discriminant analysis of document statistics.

Each text gives a fixed set of statistics, transformed to be closer to normal. Per class the mean
and the covariance are gathered over all labelled rows as sums, the covariance is shrunk towards
the pooled one and its diagonal, and its Cholesky factor is kept. A text's score is the difference
of the two log densities, by Mahalanobis distance, brought to a probability by a sigmoid that is
fitted to the counts of these differences.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import mapped, texts_of, without

_SLICE = 2_000_000
SHRINK_POOLED, SHRINK_DIAGONAL = 0.1, 0.1
_LIMIT = 60.0
_BINS = 600
NAMES = (
    "words", "word_length", "word_spread", "longest", "upper", "digits", "symbols", "stops", "non_ascii",
    "capital_words", "odd_words", "different", "top_word", "again", "lines", "line_words", "same_lines", "packed",
)
SIZE = len(NAMES)
_UPPER, _DIGIT, _LETTER, _STOP, _SYMBOL = (np.zeros(256, bool) for _ in range(5))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_STOP[list(b".,;:?")] = True
_SYMBOL[33:127] = ~(_LETTER | _DIGIT | _STOP)[33:127]
_KINDS = np.stack([_UPPER, _DIGIT, _LETTER, _STOP, _SYMBOL]).astype(np.float64)
_HIGH = np.zeros(256)
_HIGH[128:] = 1


def _odds(share: float) -> float:
    return float(np.log((share + 0.002) / (1.002 - share)))


def statistics(text: str) -> list[float]:
    """The transformed statistics of a text; all of a text without words are those of no words."""
    words = text.split()
    if not words:
        return [0.0] * SIZE
    raw = text.encode("utf-8", "replace")
    bytes_seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, digits, letters, stops, symbols = (_KINDS @ bytes_seen).tolist()
    size, n = len(raw), len(words)
    lengths = np.fromiter(map(len, words), np.float64, n)
    seen = Counter(words)
    triples = list(zip(words, words[1:], words[2:]))
    lines = [x for x in text.split("\n") if x.strip()]
    odd = sum(map(str.isalpha, (w.rstrip(".,;:?!") for w in seen)))
    capital = sum(w.isupper() and len(w) > 1 for w in seen)
    packed = len(zlib.compress(raw, 1))
    return [
        np.log1p(n),
        np.log1p(lengths.mean()),
        np.log1p(lengths.std()),
        np.log1p(lengths.max()),
        _odds(upper / max(letters, 1)),
        _odds(digits / size),
        _odds(symbols / size),
        _odds(stops / size),
        _odds(float(_HIGH @ bytes_seen) / size),
        _odds(capital / len(seen)),
        _odds(1 - odd / len(seen)),
        np.log(len(seen)) / np.log(n) if n > 1 else 1.0,
        _odds(seen.most_common(1)[0][1] / n),
        _odds(1 - len(set(triples)) / len(triples)) if triples else _odds(0.0),
        np.log1p(len(lines)),
        np.log1p(n / len(lines)),
        _odds(1 - len(set(lines)) / len(lines)),
        np.log(packed / size),
    ]


def features(df: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns, with `features`, the statistics of each whole text; null is empty."""
    return mapped(df, text, _SLICE, {"features": "array<double>"}, lambda part: [[statistics(t) for t in texts_of(part, "_text")]])


def _matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch[column].flatten().to_numpy().reshape(-1, SIZE)


@dataclass
class Model:
    prior: float
    means: np.ndarray | None = None
    inverses: np.ndarray | None = None  # of the Cholesky factors
    constants: np.ndarray | None = None
    slope: float = 1.0
    shift: float = 0.0

    def differences(self, x: np.ndarray) -> np.ndarray:
        """Log density of label 1 less that of label 0, per word kind of scale, bounded."""
        density = [c - 0.5 * (((x - m) @ li.T) ** 2).sum(axis=1) for m, li, c in zip(self.means, self.inverses, self.constants)]
        d = density[1] - density[0]
        return np.sign(d) * np.log1p(np.abs(d))

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.prior)
        z = self.slope * self.differences(x) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -_LIMIT, _LIMIT)))


def _sums(df: DataFrame, label: str) -> dict[int, np.ndarray]:
    """Per class the number of rows, the sum of features and the sum of their products."""

    def partial(batches):
        total = np.zeros((2, 1 + SIZE + SIZE * SIZE))
        for batch in batches:
            x, y = _matrix(batch, "features"), batch["label"].to_numpy()
            for c in (0, 1):
                own = x[y == c]
                total[c] += np.concatenate(([len(own)], own.sum(axis=0), (own.T @ own).ravel()))
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array(total.tolist())], names=["label", "parts"])

    parts = df.select("features", F.col(label).cast("int").alias("label")).mapInArrow(partial, "label int, parts array<double>")
    summed = parts.select("label", F.posexplode("parts").alias("at", "value")).groupBy("label", "at").agg(F.sum("value").alias("value")).collect()
    out = {c: np.zeros(1 + SIZE + SIZE * SIZE) for c in (0, 1)}
    for r in summed:
        out[r["label"]][r["at"]] = r["value"]
    return out


def fit(df: DataFrame, label: str = "quality", pooled: float = SHRINK_POOLED, diagonal: float = SHRINK_DIAGONAL) -> Model:
    """Learns from all rows with `features` and a label of 0 or 1; other or null labels, and null
    features, teach nothing. Repeated rows count each.

    If one of the classes has no row, every score is the share of label 1, or 0.5 without any row.
    df must be stored, since it is read twice.
    """
    rows = df.filter(F.col(label).isin(0, 1) & F.col("features").isNotNull())
    sums = _sums(rows, label)
    n = np.array([sums[c][0] for c in (0, 1)])
    if not n.all():
        return Model(0.5 if not n.any() else float(n[1] > 0))
    means = np.stack([sums[c][1 : 1 + SIZE] / n[c] for c in (0, 1)])
    own = np.stack([sums[c][1 + SIZE :].reshape(SIZE, SIZE) / n[c] - np.outer(means[c], means[c]) for c in (0, 1)])
    both = np.tensordot(n / n.sum(), own, axes=1)
    floor = np.diag(np.maximum(np.diag(both), 1e-3))
    inverses, constants = [], []
    for c in (0, 1):
        shrunk = (1 - pooled) * own[c] + pooled * both
        shrunk = (1 - diagonal) * shrunk + diagonal * floor
        factor = np.linalg.cholesky(shrunk + 1e-6 * np.eye(SIZE))
        inverses.append(np.linalg.inv(factor))
        constants.append(np.log(n[c] / n.sum()) - np.log(np.diag(factor)).sum())
    model = Model(float(n[1] / n.sum()), means, np.stack(inverses), np.array(constants))
    model.slope, model.shift = _sigmoid(rows, label, model)
    return model


def _sigmoid(rows: DataFrame, label: str, model: Model) -> tuple[float, float]:
    """Slope and shift of the sigmoid that fits the labels, from a histogram of the differences."""
    edge = 12.0

    def binned(batches):
        for batch in batches:
            d = model.differences(_matrix(batch, "features"))
            at = ((np.clip(d, -edge, edge) + edge) / (2 * edge) * (_BINS - 1)).round().astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch["label"]], names=["at", "label"])

    counted = rows.select("features", F.col(label).cast("int").alias("label")).mapInArrow(binned, "at long, label int").groupBy("at", "label").count().collect()
    x = np.array([r["at"] / (_BINS - 1) * 2 * edge - edge for r in counted])
    y = np.array([float(r["label"]) for r in counted])
    w = np.array([float(r["count"]) for r in counted])
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -_LIMIT, _LIMIT)))
        g = np.array([(w * (p - y) * x).sum() + 1e-2 * (a - 1), (w * (p - y)).sum() + 1e-2 * b])
        v = w * p * (1 - p)
        h = np.array([[(v * x * x).sum(), (v * x).sum()], [(v * x).sum(), v.sum()]]) + 1e-2 * np.eye(2)
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def score(df: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """All rows and columns, with the probability, 0 to 1, that a row's `features` are of label 1.

    Rows may repeat; null features have a null score. A column named `out` is replaced.
    """
    kept = without(df, [out])

    def run(batches):
        for batch in batches:
            known = pc.is_valid(batch["features"])
            scores = np.full(batch.num_rows, np.nan)
            if batch.num_rows:
                held = batch.filter(known)
                scores[known.to_numpy(zero_copy_only=False)] = model.scores(_matrix(held, "features")) if held.num_rows else []
            yield batch.append_column(out, pa.array(scores, mask=np.isnan(scores)))

    return kept.mapInArrow(run, T.StructType([*kept.schema, T.StructField(out, T.DoubleType())]))

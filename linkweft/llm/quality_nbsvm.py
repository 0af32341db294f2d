"""Quality classifier: linear support vectors on n-grams scaled by naive Bayes ratios.

Word and character n-gram indicators are multiplied by the log ratio of their class
counts; a linear model with hinge loss is fitted to them by dual coordinate descent, and
its margins are turned into probabilities on rows held back from the fit.  The fit takes
a bounded sample of labelled rows (`limit`); every document is scored on its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweft.llm import words as W
from linkweft.llm.frames import without
from linkweft.llm.ngrams import BITS, ngrams
from linkweft.llm.training import platt, sigmoid, training_texts

# Most labelled rows the model is fitted to.
FIT_ROWS = 5_000
SIZES = {"word_sizes": (1, 2), "char_sizes": (3,)}


@dataclass
class NbSvm:
    """Weight per hashed n-gram (the log ratio is multiplied in), and the calibration."""

    ratio: np.ndarray
    weight: np.ndarray
    slope: float
    intercept: float

    def margins(self, texts: pa.Array) -> np.ndarray:
        owner, feature, _ = ngrams(texts, **SIZES)
        r = self.ratio[feature]
        dot = np.bincount(owner, r * self.weight[feature], len(texts))
        norm = np.sqrt(np.bincount(owner, r * r, len(texts)))
        return dot / np.maximum(norm, 1e-9)

    def scores(self, texts: pa.Array) -> np.ndarray:
        return sigmoid(self.slope * self.margins(texts) + self.intercept)


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", limit: int = FIT_ROWS) -> NbSvm:
    """Fit to the sampled labelled rows.  With one class only, every score is that class's share."""
    rows = training_texts(docs, labels, target, limit).select("doc_id", "label", "text")
    found = rows.mapInArrow(_indicators, "doc_id long, label int, features binary").toPandas()
    found = found.sort_values("doc_id", kind="stable").drop_duplicates("doc_id")
    y = found["label"].to_numpy(dtype=np.int64)
    rows_of = [np.frombuffer(f, dtype=np.int32) for f in found["features"]]
    slots = 1 << BITS
    if len(set(y)) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        return NbSvm(np.zeros(slots, np.float32), np.zeros(slots, np.float32), 1.0, float(np.log(share / (1 - share))))
    held = np.arange(len(y)) % 4 == 3 if min(y.sum(), len(y) - y.sum()) >= 8 else np.ones(len(y), dtype=bool)
    used = np.flatnonzero(~held) if not held.all() else np.arange(len(y))
    counts = [np.ones(slots), np.ones(slots)]
    for i in used:
        counts[y[i]][rows_of[i]] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    weight = _dual_descent([rows_of[i] for i in used], np.where(y[used] == 1, 1.0, -1.0), ratio)
    model = NbSvm(ratio.astype(np.float32), weight.astype(np.float32), 1.0, 0.0)
    margins = np.array([(weight[f] * ratio[f]).sum() / max(np.sqrt((ratio[f] ** 2).sum()), 1e-9) for f in rows_of])
    model.slope, model.intercept = platt(margins[held], y[held])
    return model


def _dual_descent(rows: list[np.ndarray], sign: np.ndarray, ratio: np.ndarray, cost: float = 4.0, passes: int = 12) -> np.ndarray:
    """Linear hinge loss, solved in the dual one row at a time; classes weigh the same."""
    values = []
    for f in rows:
        v = ratio[f]
        values.append(v / max(np.sqrt((v * v).sum()), 1e-9))
    n = len(rows)
    most = np.where(sign > 0, cost * n / (2 * (sign > 0).sum()), cost * n / (2 * (sign < 0).sum()))
    alpha, weight = np.zeros(n), np.zeros(len(ratio))
    order = np.random.default_rng(7)
    for _ in range(passes):
        moved = 0.0
        for i in order.permutation(n):
            gradient = sign[i] * (weight[rows[i]] * values[i]).sum() - 1.0
            new = min(max(alpha[i] - gradient, 0.0), most[i])
            if new != alpha[i]:
                weight[rows[i]] += (new - alpha[i]) * sign[i] * values[i]
                moved, alpha[i] = max(moved, abs(new - alpha[i])), new
        if moved < 1e-3:
            break
    return weight


def _indicators(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.slices(batches, "text"):
        owner, feature, _ = ngrams(batch.column("text"), **SIZES)
        bounds = np.searchsorted(owner, np.arange(batch.num_rows + 1))
        feature = feature.astype(np.int32)
        packed = [feature[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(packed, pa.binary())], ["doc_id", "label", "features"])


def score(docs: DataFrame, model: NbSvm, text_col: str = "text", out: str = "score") -> DataFrame:
    """`docs` with a probability (0 to 1) of label 1 per whole text; null counts as empty.

    An empty text gets the probability at margin 0.  An input column named `out` is replaced.
    """
    kept = without(docs, [out])
    rows = kept.select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(model.scores(batch.column("text")), pa.float64())], ["row", "score"])

    return rows.mapInArrow(scored, f"row {kept.schema.simpleString()}, score double").select("row.*", F.col("score").alias(out))

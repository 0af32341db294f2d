"""Quality rules: fixed limits on word statistics, and a calibrated n-gram model.

The model is a logistic regression on hashed word and character n-grams, fitted to a
bounded sample of labelled rows (`limit`), calibrated on rows held back, and scored in
Arrow batches against a fixed probability.  All statistics cover whole texts.
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
FIT_ROWS = 4_000
SIZES = {"word_sizes": (1,), "char_sizes": (4,)}

# Fixed limits: fewest words, most repeated words per 100 words, least probability kept.
LEAST_WORDS = 50
MOST_REPEATED = 50
LEAST_SCORE = 0.3

# Characters that count as symbols (fixed values).
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
OUTPUTS = (*COUNTS, "base_failed", "score", "kept")


@dataclass
class Logistic:
    weight: np.ndarray
    bias: float
    slope: float
    intercept: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        owner, feature, count = ngrams(texts, **SIZES)
        value = np.log1p(count)
        dot = np.bincount(owner, value * self.weight[feature], len(texts))
        norm = np.sqrt(np.bincount(owner, value * value, len(texts)))
        return sigmoid(self.slope * (dot / np.maximum(norm, 1e-9) + self.bias) + self.intercept)


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", limit: int = FIT_ROWS) -> Logistic:
    """Fit to the sampled labelled rows.  With one class only, every score is that class's share."""
    found = training_texts(docs, labels, target, limit).mapInArrow(_features, "doc_id long, label int, features binary, values binary").toPandas()
    found = found.sort_values("doc_id", kind="stable").drop_duplicates("doc_id")
    y = found["label"].to_numpy(dtype=np.int64)
    slots = 1 << BITS
    if len(set(y)) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        return Logistic(np.zeros(slots, np.float32), 0.0, 1.0, float(np.log(share / (1 - share))))
    rows = [(np.frombuffer(f, np.int32), np.frombuffer(v, np.float32)) for f, v in zip(found["features"], found["values"])]
    held = np.arange(len(y)) % 4 == 3 if min(y.sum(), len(y) - y.sum()) >= 8 else np.ones(len(y), dtype=bool)
    used = np.flatnonzero(~held) if not held.all() else np.arange(len(y))
    weight, bias = _descend(rows, y, used)
    margins = np.array([(weight[f] * v).sum() + bias for f, v in rows])
    slope, intercept = platt(margins[held], y[held])
    return Logistic(weight.astype(np.float32), bias, slope, intercept)


def _descend(rows, y: np.ndarray, used: np.ndarray, passes: int = 12, size: int = 32) -> tuple[np.ndarray, float]:
    """Logistic loss with classes of equal weight, by small batches with adaptive steps."""
    weight, squares, bias = np.zeros(1 << BITS), np.full(1 << BITS, 1e-6), 0.0
    share = y[used].mean()
    order = np.random.default_rng(11)
    for _ in range(passes):
        for part in np.array_split(order.permutation(used), max(1, len(used) // size)):
            lengths = np.array([len(rows[i][0]) for i in part])
            f, v = np.concatenate([rows[i][0] for i in part]), np.concatenate([rows[i][1] for i in part])
            owner = np.repeat(np.arange(len(part)), lengths)
            p = sigmoid(np.bincount(owner, weight[f] * v, len(part)) + bias)
            error = (p - y[part]) * np.where(y[part] == 1, 0.5 / share, 0.5 / (1 - share)) / len(part)
            slots, back = np.unique(f, return_inverse=True)
            gradient = np.bincount(back, v * error[owner])
            squares[slots] += gradient * gradient
            weight[slots] -= 0.5 * gradient / np.sqrt(squares[slots])
            bias -= 0.1 * error.sum()
    return weight, bias


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.slices(batches, "text"):
        owner, feature, count = ngrams(batch.column("text"), **SIZES)
        value = np.log1p(count)
        norm = np.sqrt(np.bincount(owner, value * value, batch.num_rows))
        value = (value / np.maximum(norm, 1e-9)[owner]).astype(np.float32)
        feature = feature.astype(np.int32)
        bounds = np.searchsorted(owner, np.arange(batch.num_rows + 1))
        cuts = list(zip(bounds[:-1], bounds[1:]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array([feature[a:b].tobytes() for a, b in cuts], pa.binary()), pa.array([value[a:b].tobytes() for a, b in cuts], pa.binary())],
            ["doc_id", "label", "features", "values"],
        )


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """Word and line statistics of every whole text (null: empty), as long arrays."""
    words = W.split(texts)
    data, ends = W.text_bytes(texts)
    h = W.hashes(words)
    inside = ~W.WHITE[data]
    points = inside & ((data & 0xC0) != 0x80)
    counted = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[ends])
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": counted(points),
        "n_symbols": counted(SYMBOLS[data]),
        "n_dup_lines": _repeated_lines(data, ends, inside),
        "n_repeat_words": _repeated_words(words, h),
    }


def _repeated_lines(data: np.ndarray, ends: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Lines (cut at newlines) with a word which equal an earlier line of their text."""
    breaks = np.zeros(256, dtype=bool)
    breaks[0x0A] = True
    edge = ends[:-1][np.diff(ends) > 0]
    newline = np.flatnonzero(breaks[data])
    starts = np.unique(np.concatenate([edge, newline + 1]))
    starts = starts[starts < len(data)]
    text = np.searchsorted(ends, starts, side="right") - 1
    stops = np.concatenate([starts[1:], [len(data)]])[: len(starts)] if len(starts) else starts
    stops = np.minimum(stops, ends[text + 1]) if len(starts) else stops
    stops = np.where((stops > starts) & (data[np.maximum(stops - 1, 0)] == 0x0A), stops - 1, stops) if len(starts) else stops
    seen = np.concatenate([[0], np.cumsum(inside, dtype=np.int64)])
    with_word = seen[stops] > seen[starts]
    starts, stops, text = starts[with_word], stops[with_word], text[with_word]
    line = W.hashes(W.Words(data, starts, stops, np.zeros(0, dtype=np.int64)))
    order = np.lexsort((line, text))
    same = (line[order][1:] == line[order][:-1]) & (text[order][1:] == text[order][:-1])
    return np.bincount(text[order][1:][same], minlength=len(ends) - 1).astype(np.int64)


def _repeated_words(words: W.Words, h: np.ndarray) -> np.ndarray:
    """Words inside a window of three words which is found twice or more in the text."""
    at = W.inside_text(words, 3)
    if not len(at):
        return np.zeros(len(words.first) - 1, dtype=np.int64)
    owner = words.text_of()
    gram = W.mix(W.windows(h, 3)[at])
    order = np.lexsort((gram, owner[at]))
    same = (gram[order][1:] == gram[order][:-1]) & (owner[at][order][1:] == owner[at][order][:-1])
    twice = np.zeros(len(at), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[at[twice] + k] = True
    return np.bincount(owner[covered], minlength=len(words.first) - 1).astype(np.int64)


def apply_rules(docs: DataFrame, model: Logistic, text_col: str = "text") -> DataFrame:
    """`docs` with the statistics, base_failed, score (0 to 1) and kept.

    A null text counts as empty: no words, so base_failed.  Input columns named like an
    output are replaced.  Equal texts get equal results.
    """
    kept = without(docs, [c for c in OUTPUTS if c != text_col])
    rows = kept.select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text"):
            texts = batch.column("text")
            stats = statistics(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *[pa.array(stats[c], pa.int64()) for c in COUNTS], pa.array(model.scores(texts), pa.float64())],
                ["row", *COUNTS, "score"],
            )

    out = rows.mapInArrow(judged, f"row {kept.schema.simpleString()}, {', '.join(f'{c} long' for c in COUNTS)}, score double")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return out.select("row.*", *COUNTS, failed.alias("base_failed"), "score", (~failed & (F.col("score") >= LEAST_SCORE)).alias("kept"))

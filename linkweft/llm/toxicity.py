"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of an insult lexicon and of stems learned from
labelled rows, how near those stand to second-person words, and rates of capitals,
punctuation and spelled-over words.  Python computes them in Arrow batches; trees and
calibration are those of Spark ML, which also scores in the JVM.

The fit takes a bounded sample of labelled rows (`limit`).  Rows get their features by the
stems that were learned from the other half, trees are fitted to four fifths of the rows
and calibrated on the rest, so that no row is judged by its own label.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweft.llm import words as W
from linkweft.llm.frames import without, written
from linkweft.llm.training import training_texts

# Most labelled rows the model is fitted to, and most stems that are learned.
FIT_ROWS = 12_000
STEMS = 2_000

# A stem counts if it is in so many toxic texts of the sample, and this much more often there.
STEM_TEXTS = 4
STEM_LOG_ODDS = 2.0

# Bytes of the word beginnings that may be stems.
PREFIXES = (4, 5, 6, 7, 8)

# Words of this distance to a second-person word are near it.
NEAR = 4

# Insults and forms of address (fixed values).
INSULTS = (
    "idiot idiots idiotic moron morons stupid dumb fool fools loser losers scum trash garbage worthless pathetic "
    "disgusting clown clowns ugly filthy vermin coward cowards jerk imbecile dimwit lowlife creep freak pig pigs "
    "hate kill die shut despicable vile"
)
ADDRESSES = (
    "you your yours yourself yourselves u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch "
    "usted ustedes ti vosotros"
)

# Digits and signs written for letters (fixed values).
WRITTEN_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a"}

FEATURES = (
    "log_words", "insult_density", "log_insults", "stem_density", "stem_weight", "highest_stem",
    "address_density", "near_density", "capital_share", "shout_rate", "punctuation_share", "obfuscation_rate", "long_word_share",
)

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[0x41:0x5B] = True
_SHOUT = np.zeros(256, dtype=bool)
_SHOUT[list(b"!?")] = True
_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_OVER = np.zeros(256, dtype=bool)
_OVER[list(b"0123456789@$!*#.+_")] = True
_SPELLED = np.arange(256, dtype=np.uint8)
for _sign, _letter in WRITTEN_FOR.items():
    _SPELLED[ord(_sign)] = ord(_letter)


@dataclass
class Toxicity:
    """Learned stems, trees and calibration; without trees every score is `share`."""

    stems: np.ndarray
    weights: np.ndarray
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    share: float


def _normal(texts: pa.Array) -> W.Words:
    """Words in lower case, with letters for the signs that are written for them."""
    lower = pc.utf8_lower(texts.fill_null(""))
    data, ends = W.text_bytes(lower)
    plain = pa.Array.from_buffers(pa.large_string(), len(lower), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(_SPELLED[data])])
    return W.split(plain, W.NOT_ALNUM)


def _word_hashes(words: str) -> np.ndarray:
    return np.sort(W.hashes(W.split(pa.array([words]))))


def _stem_keys(words: W.Words, h: np.ndarray) -> list[np.ndarray]:
    """The hash of each word, and of its beginning for each length of `PREFIXES`."""
    padded = np.concatenate([words.data, np.zeros(8, dtype=np.uint8)])
    eight = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
    head, length = eight[words.starts], words.ends - words.starts
    keys = [h]
    for size in PREFIXES:
        beginning = head if size == 8 else head & np.uint64((1 << (8 * size)) - 1)
        keys.append(np.where(length > size, W.mix(beginning ^ np.uint64(size * 0x0101010101010101)), np.uint64(0)))
    return keys


def _found(keys: np.ndarray, lexicon: np.ndarray) -> np.ndarray:
    """The place of each key in a sorted lexicon, or -1."""
    out = np.full(len(keys), -1, dtype=np.int64)
    if len(lexicon):
        maybe = np.zeros(1 << 16, dtype=bool)
        maybe[(lexicon >> np.uint64(48)).astype(np.int64)] = True
        some = np.flatnonzero(maybe[(keys >> np.uint64(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(lexicon, keys[some]), len(lexicon) - 1)
        out[some] = np.where(lexicon[at] == keys[some], at, -1)
    return out


def features(texts: pa.Array, stems: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """One row of `FEATURES` per text; a text without words has rates of 0."""
    n = len(texts)
    words = _normal(texts)
    h, owner, total = W.hashes(words), words.text_of(), np.maximum(words.counts, 1)
    per_text = lambda mask, by=None: np.bincount(owner[mask], None if by is None else by[mask], n)
    insult = _found(h, _word_hashes(INSULTS)) >= 0
    address = _found(h, _word_hashes(ADDRESSES)) >= 0
    weight = np.zeros(len(h))
    for keys in _stem_keys(words, h):
        place = _found(keys, stems)
        weight = np.maximum(weight, np.where(place >= 0, weights[place] if len(weights) else 0.0, 0.0))
    stem = weight > 0
    highest = np.zeros(n)
    np.maximum.at(highest, owner[stem], weight[stem])
    close = np.zeros(len(h), dtype=bool)
    spots = np.flatnonzero(address)
    for step in range(-NEAR, NEAR + 1):
        other = spots + step
        ok = (other >= 0) & (other < len(h))
        ok[ok] = owner[other[ok]] == owner[spots[ok]]
        close[other[ok]] = True
    data, ends = W.text_bytes(texts)
    size = np.maximum(np.diff(ends), 1)
    counted = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[ends])
    over = np.zeros(len(data), dtype=bool)
    if len(data) > 2:
        over[1:-1] = _OVER[data[1:-1]] & _LETTER[data[:-2]] & _LETTER[data[2:]]
    letters = np.maximum(counted(_LETTER[data]), 1)
    return np.stack(
        [
            np.log1p(words.counts),
            per_text(insult) / total,
            np.log1p(per_text(insult)),
            per_text(stem) / total,
            np.log1p(per_text(stem, weight)),
            highest,
            per_text(address) / total,
            per_text(close & (insult | stem)) / total,
            counted(_UPPER[data]) / letters,
            counted(_SHOUT[data]) / total,
            counted(_PUNCTUATION[data]) / size,
            counted(over) / total,
            per_text((words.ends - words.starts) > 12) / total,
        ],
        axis=1,
    )


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", limit: int = FIT_ROWS) -> Toxicity:
    """Fit to the sampled labelled rows.  If a part lacks a class, scores are the share of label 1."""
    rows = training_texts(docs, labels, target, limit).withColumn("part", F.pmod(F.hash("doc_id", F.lit(3)), F.lit(5)))
    rows = written(rows, "toxicity-sample")
    counts = {(r["part"], r["label"]): r["n"] for r in rows.groupBy("part", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = lambda parts, label: sum(counts.get((p, label), 0) for p in parts)
    share = (total(range(5), 1) + 1) / (total(range(5), 0) + total(range(5), 1) + 2)
    halves, held_back = ((0, 1), (2, 3, 4)), 4
    each = [_learn_stems(rows.where(F.col("part").isin(*half)), total(half, 0), total(half, 1)) for half in halves]
    stems, weights = _learn_stems(rows, total(range(5), 0), total(range(5), 1))
    if min(total(p, k) for p in (range(4), (held_back,)) for k in (0, 1)) < 2:
        return Toxicity(stems, weights, None, None, share)
    parts = [with_features(rows.where(F.col("part").isin(*half)), *other).select("part", "label", "features") for half, other in zip(halves, reversed(each))]
    made = written(parts[0].unionByName(parts[1]).coalesce(2), "toxicity-features")
    ready = made.select("part", F.col("label").cast("double").alias("label"), array_to_vector("features").alias("vector"))
    trees = GBTClassifier(labelCol="label", featuresCol="vector", maxIter=25, maxDepth=4, stepSize=0.15, maxBins=48, minInstancesPerNode=3, subsamplingRate=0.9, seed=17).fit(ready.where(F.col("part") != held_back))
    held = trees.transform(ready.where(F.col("part") == held_back)).select("label", vector_to_array("probability")[1].alias("raw"))
    calibration = IsotonicRegression(labelCol="label", featuresCol="raw", predictionCol="even").fit(held)
    return Toxicity(stems, weights, trees, calibration, share)


def _learn_stems(rows: DataFrame, negative: int, positive: int) -> tuple[np.ndarray, np.ndarray]:
    """Words and word beginnings that toxic texts hold much more often, with their log odds."""
    counts = rows.select("label", "text").mapInArrow(_stem_counts, "key long, positive long, negative long")
    odds = F.log((F.col("positive") + 0.5) / (positive + 1)) - F.log((F.col("negative") + 0.5) / (negative + 1))
    best = (
        counts.groupBy("key")
        .agg(F.sum("positive").alias("positive"), F.sum("negative").alias("negative"))
        .where(F.col("positive") >= STEM_TEXTS)
        .select("key", "positive", odds.alias("odds"))
        .where(F.col("odds") >= STEM_LOG_ODDS)
        .orderBy((F.col("positive") * F.col("odds")).desc(), "key")
        .limit(STEMS)
        .collect()
    )
    keys = np.array([r["key"] for r in best], dtype=np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.array([r["odds"] for r in best], dtype=np.float64)[order]


def _stem_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.slices(batches, "text"):
        words = _normal(batch.column("text"))
        owner = words.text_of()
        label = np.asarray(batch.column("label"))
        keys = np.concatenate(_stem_keys(words, W.hashes(words)))
        who = np.tile(owner, len(PREFIXES) + 1)
        who, keys = who[keys != 0], keys[keys != 0]
        order = np.lexsort((who, keys))
        who, keys = who[order], keys[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (who[1:] != who[:-1])
        found, back = np.unique(keys[new], return_inverse=True)
        toxic = np.bincount(back, label[who[new]] == 1, len(found)).astype(np.int64)
        every = np.bincount(back, minlength=len(found)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(toxic), pa.array(every - toxic)], ["key", "positive", "negative"])


def with_features(docs: DataFrame, stems: np.ndarray, weights: np.ndarray, text_col: str = "text") -> DataFrame:
    """`docs` with an array of `FEATURES` per whole text; an input column `features` is replaced."""
    kept = without(docs, ["features"])
    rows = kept.select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text"):
            found = features(batch.column("text"), stems, weights)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * found.shape[1], pa.int32()), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), lists], ["row", "features"])

    return rows.mapInArrow(made, f"row {kept.schema.simpleString()}, features array<double>").select("row.*", "features")


def score(docs: DataFrame, model: Toxicity, text_col: str = "text", out: str = "score") -> DataFrame:
    """`docs` with a probability (0 to 1) of label 1 per whole text; null counts as empty.

    Rows on one step of the calibration keep the order of the trees' own score.  An input
    column named `out` is replaced.  Equal texts get equal scores.
    """
    kept = without(docs, [out])
    if model.trees is None:
        return kept.withColumn(out, F.lit(model.share))
    rows = kept.select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    made = with_features(rows, model.stems, model.weights).select("row", array_to_vector("features").alias("vector"))
    raw = model.trees.transform(made).select("row", vector_to_array("probability")[1].alias("raw"))
    return model.calibration.transform(raw).select("row.*", (0.98 * F.col("even") + 0.02 * F.col("raw")).alias(out))

"""Removal of word passages that repeat across documents.

Every window of `size` consecutive words gets a Rabin-Karp hash; windows are counted in
Spark, and a window which also starts in a document with a smaller id is removed.
Repeated windows of one document that touch or overlap form one maximal interval.

Three steps keep the shuffled rows few while every window stays covered:

1.  Documents with the same sequence of words need no window counts: all but the one
    with the smallest id are repeats as a whole.
2.  Each window is keyed by the least hash among its inner grams of size // 2 words.
    Equal windows have equal keys, so a window whose key is in one text only cannot
    repeat.  Neighbouring windows mostly share their key: about 2 keys per size // 2 words.
3.  Windows with a key that several texts share are hashed whole and counted.

Counts and least ids are combined before each shuffle; a passage in a third of all
documents is one group of an aggregation and one key of a join whose skewed side Spark
splits; the other side is a written table, as Spark splits only what it shuffles for the
join itself.  No rows of a key are gathered; only the positions within one document are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweft.llm import words as W
from linkweft.llm.frames import without, written

WINDOW = 50
OUTPUTS = ("n_words", "n_removed", "kept_text")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """`docs` with n_words, n_removed (long) and kept_text (kept words joined by one space).

    Words are runs of other characters than ASCII white space, unchanged.  A null text has
    no words; a text with fewer than `size` words is kept whole.  Rows with the same id do
    not remove each other; equal rows get equal results.  A row with a null id is kept
    whole and removes nothing.  Input columns named like an output are replaced.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    known = rows.where("id is not null")
    texts = known.mapInArrow(_text_hashes, "id long, text_hash binary, n_words long").where(F.col("n_words") >= size)
    firsts = texts.groupBy("text_hash").agg(F.min("id").alias("first_id"))
    status = written(texts.join(firsts, "text_hash").select("id", "text_hash", (F.col("id") > F.col("first_id")).alias("copy")).distinct(), "text-status")

    keys = known.mapInArrow(_window_keys(size), "id long, text_hash binary, key long")
    shared = keys.groupBy("key").agg(F.min("text_hash").alias("low"), F.max("text_hash").alias("high")).where("low < high").select("key")
    shared = written(shared, "shared-keys")
    wanted = (
        keys.join(shared, "key")
        .groupBy("id", "text_hash")
        .agg(F.collect_set("key").alias("shared_keys"))
        .join(status.where("not copy"), ["id", "text_hash"], "left_semi")
        .withColumnRenamed("id", "wanted_id")
    )
    candidates = written(
        known.join(wanted, F.col("id") == F.col("wanted_id")).select("id", "text", "text_hash", "shared_keys").mapInArrow(_shared_windows(size), "id long, text_hash binary, at int, window long"),
        "repeat-windows",
    )
    least = candidates.groupBy("window").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id")).where("first_id < last_id").select("window", "first_id")
    least = written(least, "least-ids")
    repeats = candidates.join(least, "window").where("id > first_id").groupBy("id", "text_hash").agg(F.collect_list("at").alias("repeats"))
    found = (
        repeats.unionByName(status.where("copy").select("id", "text_hash", F.lit(None).cast("array<int>").alias("repeats")))
        .groupBy(F.col("id").alias("found_id"))
        .agg(F.collect_list(F.struct("text_hash", "repeats")).alias("found"))
    )

    kept = without(docs, [c for c in OUTPUTS if c not in (id_col, text_col)])
    carried = kept.select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("row"))
    joined = carried.join(found, F.col(f"row.`{id_col}`").cast("long") == F.col("found_id"), "left").select("row", F.col(f"row.`{text_col}`").alias("text"), "found")
    schema = f"row {kept.schema.simpleString()}, n_words long, n_removed long, kept_text string"
    out = joined.mapInArrow(_cut(size), schema)
    return out.select("row.*", *OUTPUTS)


def _hash_of(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _text_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.slices(batches, "text"):
        words = W.split(batch.column("text"))
        h, first = W.hashes(words), words.first
        digests = [_hash_of(h[a:b]) for a, b in zip(first[:-1], first[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(digests, pa.binary()), pa.array(words.counts.astype(np.int64))],
            ["id", "text_hash", "n_words"],
        )


def _keyed(words: W.Words, h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start words of all windows, and the least inner gram hash of each."""
    at = W.inside_text(words, size)
    gram = max(1, size // 2)
    grams = W.mix(W.windows(h, gram))
    reach = size - gram + 1
    least, length = grams, 1
    while length * 2 <= reach:
        least = np.minimum(least[: len(least) - length], least[length:])
        length *= 2
    return at, np.minimum(least[at], least[at + reach - length]) if len(at) else np.zeros(0, dtype=np.uint64)


def _window_keys(size: int):
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text"):
            words = W.split(batch.column("text"))
            h = W.hashes(words)
            at, key = _keyed(words, h, size)
            if not len(at):
                continue
            text = words.text_of()[at]
            new = np.ones(len(at), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
            text, key = text[new], key[new]
            used = np.unique(text)
            digests = pa.array([_hash_of(h[words.first[d] : words.first[d + 1]]) for d in used], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(text)), digests.take(pa.array(np.searchsorted(used, text))), pa.array(key.view(np.int64))],
                ["id", "text_hash", "key"],
            )

    return keys


def _shared_windows(size: int):
    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text"):
            words = W.split(batch.column("text"))
            h = W.hashes(words)
            at, key = _keyed(words, h, size)
            text = words.text_of()[at]
            hits = np.zeros(len(at), dtype=bool)
            bounds = np.searchsorted(text, np.arange(batch.num_rows + 1))
            for d in range(batch.num_rows):
                a, b = words.first[d], words.first[d + 1]
                if _hash_of(h[a:b]) == batch.column("text_hash")[d].as_py():
                    wanted = np.asarray(batch.column("shared_keys")[d].values).view(np.uint64)
                    hits[bounds[d] : bounds[d + 1]] = np.isin(key[bounds[d] : bounds[d + 1]], wanted)
            at, text = at[hits], text[hits]
            if len(at):
                rows = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(rows), batch.column("text_hash").take(rows), pa.array((at - words.first[text]).astype(np.int32)), pa.array(W.mix(W.windows(h, size)[at]).view(np.int64))],
                    ["id", "text_hash", "at", "window"],
                )

    return shared


def _cut(size: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text"):
            texts, found = batch.column("text"), batch.column("found")
            totals, removed, kept = [], [], []
            for d in range(batch.num_rows):
                tokens = (texts[d].as_py() or "").encode().split()
                totals.append(len(tokens))
                gone = _removed(texts, d, len(tokens), found[d].as_py() if found[d].is_valid else [], size)
                removed.append(0 if gone is None else int(gone.sum()))
                if removed[-1]:
                    tokens = [t for t, g in zip(tokens, gone) if not g]
                kept.append(b" ".join(tokens).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["row", "n_words", "n_removed", "kept_text"],
            )

    return cut


def _removed(texts: pa.Array, d: int, total: int, found: list[dict], size: int) -> np.ndarray | None:
    """True for each word inside a repeated window, merged over all of them."""
    if not found:
        return None
    own = _hash_of(W.hashes(W.split(texts.slice(d, 1))))
    for one in found:
        if one["text_hash"] == own:
            if one["repeats"] is None:
                return np.ones(total, dtype=bool)
            change = np.zeros(total + 1, dtype=np.int32)
            at = np.unique(np.asarray(one["repeats"]))
            change[at] += 1
            change[at + size] -= 1
            return np.cumsum(change[:-1]) > 0
    return None

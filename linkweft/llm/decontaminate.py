"""Benchmark items found in documents, by edit distance over words.

A document holds an item if some run of its words is within `share` of the item's number
of words, in edits (words put in, left out or replaced).  Words are compared in lower
case and without punctuation; in scripts written without spaces, such as Chinese, Japanese
or Thai, every code point counts as a word.

Candidates come from item-sized windows of the documents:

1.  An item with at most e edits keeps one of e + 1 equal pieces of itself unchanged.  So
    windows are looked at where a document has the first words of such a piece, at every
    shift of up to e words; windows elsewhere are over the limit.
2.  The CGK random walk maps each window and each item to a longer string: walk bits,
    hashed from the step and the word, say when to go on to the next word.  Few edits
    leave most steps equal, which turns edit distance into Hamming distance.
3.  Bit-sampling LSH: a window meets the item if a few sampled steps are all equal, in
    one of the repeated draws.  The number of draws follows from the target recall.
4.  What meets is verified by the exact edit distance.  Items with many edits, whose walks
    agree in too few steps for that recall, are verified at all places of 1.

Documents are not moved: items go to every task, in passes of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweft.llm import words as W

# Most edits per word of an item, and the recall of the sampled draws at that many.
SHARE = 0.2
RECALL = 0.995

# Shorter items would be met by chance and are not searched: those with fewer words, unless
# their words have this many characters in all; as no edit is allowed then, they are exact runs.
LEAST_WORDS = 5
LEAST_CHARS = 20

# Steps compared in one draw; share of equal steps that the draws are counted for; walks.
SAMPLED = 2
EQUAL_STEPS = 0.4
WALKS = 4

# Walks of items with more edits, or a larger share of them, agree in fewer steps than these.
WALKED_EDITS = 12

# What one pass over the documents takes to every task.
PASS_ITEMS = 20_000
PASS_BYTES = 8 << 20

# Windows walked at once.
WALKED_ROWS = 1 << 15

LEAK = "doc_id long, item_id long, edits int, start_word int, n_words int"


class Items:
    """The items of one pass: words, seeds to find them by, and sampled steps."""

    def __init__(self, ids: list[int | None], texts: list[str | None], share: float = SHARE, recall: float = RECALL) -> None:
        words = _normal(pa.array(texts, pa.string()))
        h = W.hashes(words)
        self.ids, self.words, self.edits = [], [], []
        for k, item_id in enumerate(ids):
            own = h[words.first[k] : words.first[k + 1]]
            spans = zip(words.starts[words.first[k] : words.first[k + 1]], words.ends[words.first[k] : words.first[k + 1]])
            if len(own) >= LEAST_WORDS or sum(int(((words.data[a:b] & 0xC0) != 0x80).sum()) for a, b in spans) >= LEAST_CHARS:
                self.ids.append(item_id)
                self.words.append(own)
                self.edits.append(int(share * len(own)) if len(own) >= LEAST_WORDS else 0)
        self.sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        self.walked = np.array([e <= WALKED_EDITS and share <= SHARE for e in self.edits], dtype=bool)
        seeds: dict[int, list[tuple[int, int, int]]] = {}
        for k, own in enumerate(self.words):
            pieces = self.edits[k] + 1
            length = len(own) // pieces
            grams = W.mix(W.windows(own, length))
            for p in range(pieces):
                at = p * len(own) // pieces
                seeds.setdefault(length, []).append((int(grams[at]), k, at))
        self.seeds = {}
        for length, found in seeds.items():
            found.sort()
            value = np.array([f[0] for f in found], dtype=np.uint64)
            maybe = np.zeros(1 << 16, dtype=bool)
            maybe[(value >> np.uint64(48)).astype(np.int64)] = True
            self.seeds[length] = (maybe, value, np.array([f[1] for f in found]), np.array([f[2] for f in found]))
        draws = math.ceil(math.log(1 - recall) / math.log(1 - EQUAL_STEPS**SAMPLED))
        self.draws = np.random.default_rng(5).random((draws, SAMPLED))

    def meet(self, texts: pa.Array) -> list[tuple[int, int, int, int, int]]:
        """(text number, item number, edits, first word, words) of every text that holds an item."""
        words = _normal(texts)
        h = W.hashes(words)
        text, item, at = self._seeded(words, h)
        if not len(text):
            return []
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        walked = np.flatnonzero(self.walked[item])
        passed = ~self.walked[item]
        for a, b in self._chunks(item[walked]):
            some = walked[a:b]
            passed[some] = self._walk_meets(words, h, text[some], item[some], at[some])
        for d, k, start, last in self._places(text[passed], item[passed], at[passed]):
            e = self.edits[k]
            low, high = max(words.first[d], start - e), min(words.first[d + 1], last + self.sizes[k] + e)
            edits, first, size = fitting(self.words[k], h[low:high])
            if edits <= e:
                found = (edits, int(low - words.first[d]) + first, size)
                key = (int(d), int(k))
                best[key] = min(best.get(key, found), found)
        return [(d, k, *found) for (d, k), found in sorted(best.items())]

    def _places(self, text: np.ndarray, item: np.ndarray, at: np.ndarray) -> list[list[int]]:
        """(text, item, first place, last place): sorted places, of which near ones of items not walked are one."""
        out: list[list[int]] = []
        for d, k, start in zip(text.tolist(), item.tolist(), at.tolist()):
            if out and not self.walked[k] and out[-1][:2] == [d, k] and start - out[-1][3] <= self.edits[k]:
                out[-1][3] = start
            else:
                out.append([d, k, start, start])
        return out

    def _seeded(self, words: W.Words, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places where a piece of an item occurs: text, item, where the item would begin."""
        owner, parts = words.text_of(), []
        for length, (maybe, value, item, offset) in self.seeds.items():
            if len(h) < length:
                continue
            at = W.inside_text(words, length)
            grams = W.mix(W.windows(h, length))[at]
            near = maybe[(grams >> np.uint64(48)).astype(np.int64)]
            at, grams = at[near], grams[near]
            low, high = np.searchsorted(value, grams), np.searchsorted(value, grams, side="right")
            many = high - low
            hit = W.ragged(low, many)
            place = np.repeat(at, many)
            parts.append(np.stack([owner[place], item[hit], place - offset[hit]]))
        if not parts:
            return (np.zeros(0, dtype=np.int64),) * 3
        found = np.unique(np.concatenate(parts, axis=1), axis=1)
        return found[0], found[1], found[2]

    def _chunks(self, item: np.ndarray) -> Iterator[tuple[int, int]]:
        """Candidates walked at once, so that their windows stay within a bound."""
        rows = np.cumsum([(2 * self.edits[k] + 1) * WALKS for k in item])
        at = 0
        while at < len(item):
            done = rows[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(rows, done + WALKED_ROWS, side="right")))
            yield at, to
            at = to

    def _walk_meets(self, words: W.Words, h: np.ndarray, text: np.ndarray, item: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Whether a window near the place agrees with the item in all steps of some draw."""
        edits = np.array([self.edits[k] for k in item])
        shifts = 2 * edits + 1
        who = np.repeat(np.arange(len(item)), shifts)
        start = at[who] - edits[who] + W.ragged(np.zeros(len(item), dtype=np.int64), shifts)
        size = self.sizes[item[who]]
        low, high = words.first[text[who]], words.first[text[who] + 1]
        longest = int(size.max()) if len(size) else 0
        own = np.zeros((len(item), longest), dtype=np.uint64)
        for row, k in enumerate(item):
            own[row, : self.sizes[k]] = self.words[k]
        met = np.zeros(len(item), dtype=bool)
        for walk in range(WALKS):
            of_item = _walk(lambda row, i: own[row, np.minimum(i, longest - 1)], self.sizes[item], walk)
            of_window = _walk(lambda row, i: np.where((start[row] + i >= low[row]) & (start[row] + i < high[row]), h[np.clip(start[row] + i, 0, len(h) - 1)], np.uint64(1)), size, walk)
            equal = of_window == of_item[who]
            for draw in self.draws[walk::WALKS]:
                agree = np.ones(len(who), dtype=bool)
                for u in draw:
                    agree &= equal[np.arange(len(who)), (u * 2 * size).astype(np.int64)]
                met[who[agree]] = True
        return met


def _walk(word_at, sizes: np.ndarray, walk: int) -> np.ndarray:
    """CGK walks of many strings at once: the word stood on at each of twice as many steps."""
    steps = 2 * int(sizes.max())
    out = np.zeros((len(sizes), steps), dtype=np.uint64)
    place, rows = np.zeros(len(sizes), dtype=np.int64), np.arange(len(sizes))
    for step in range(steps):
        word = np.where(place < sizes, word_at(rows, place), np.uint64(0))
        out[:, step] = word
        place += (W.mix(word ^ np.uint64((walk << 40) + step + 1)) >> np.uint64(63)).astype(np.int64)
    return out


def fitting(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least edits between `item` and any run of `text`; first word and number of words of the run."""
    edits, end = _fit(item, text)
    _, back = _fit(item[::-1], text[:end][::-1], whole_start=True)
    return edits, end - back, back


def _fit(item: np.ndarray, text: np.ndarray, whole_start: bool = False) -> tuple[int, int]:
    index = np.arange(len(text) + 1)
    row = index.copy() if whole_start else np.zeros(len(text) + 1, dtype=np.int64)
    for k, word in enumerate(item):
        new = row + 1
        new[1:] = np.minimum(new[1:], row[:-1] + (text != word))
        row = np.minimum.accumulate(new - index) + index
    end = int(row.argmin())
    return int(row[end]), end


def _normal(texts: pa.Array) -> W.Words:
    return W.split(pc.utf8_lower(texts), W.NOT_ALNUM, unspaced=True)


def passes(items: DataFrame, share: float = SHARE, recall: float = RECALL) -> Iterator[Items]:
    """The items, of which each pass takes `PASS_ITEMS` and `PASS_BYTES` or about so many."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").isNotNull())
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    count = max(math.ceil(size["n"] / PASS_ITEMS), math.ceil(size["b"] / PASS_BYTES))
    for k in range(count):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k).orderBy("item_id", "text").collect()
        found = Items([r["item_id"] for r in part], [r["text"] for r in part], share, recall)
        if found.ids:
            yield found


def find_leaks(docs: DataFrame, items: DataFrame, share: float = SHARE, recall: float = RECALL) -> DataFrame:
    """(doc_id, item_id, edits, start_word, n_words): the best run of each document and item.

    Null and empty texts hold nothing; items with under `LEAST_WORDS` words and
    `LEAST_CHARS` characters are not searched; repeated rows and items are reported each.  Ties go to the first run.  An empty
    table on either side gives no rows.  Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for taken in passes(items, share, recall):
        shared = spark.sparkContext.broadcast(taken)

        def found(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in W.slices(batches, "text"):
                hits = shared.value.meet(batch.column("text"))
                if hits:
                    ids = batch.column("doc_id").take(pa.array([x[0] for x in hits], pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array([shared.value.ids[x[1]] for x in hits], pa.int64()), *[pa.array([x[k] for x in hits], pa.int32()) for k in (2, 3, 4)]],
                        ["doc_id", "item_id", "edits", "start_word", "n_words"],
                    )

        part = rows.mapInArrow(found, LEAK)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], LEAK)


def drop_leaks(docs: DataFrame, items: DataFrame, share: float = SHARE, recall: float = RECALL) -> DataFrame:
    """The rows of `docs` whose text holds no item; rows are not moved."""
    spark, columns = docs.sparkSession, docs.columns
    out = docs
    for taken in passes(items, share, recall):
        shared = spark.sparkContext.broadcast(taken)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in W.slices(batches, "text"):
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[x[0] for x in shared.value.meet(batch.column("text"))]] = False
                yield batch.filter(pa.array(keep))

        out = out.mapInArrow(clean, out.schema)
    return out.select(*[F.col(f"`{c}`") for c in columns])

"""Phrases of two to four words that occur often and hold together, per language.

1.  Every task cuts the texts of a language into shards of about SHARD_WORDS words, each
    with its own dictionary; counts of words are summed over the shards.
2.  A shard becomes an FM-index over the numbers of its frequent words (`fm_index`); rare
    words and punctuation are breaks, as no phrase that is frequent holds a rare word.
3.  Patterns are extended in each index by one word to the left, to the right, and to the
    left again, with their counts.  The patterns of a length are dealt into buckets by a
    hash, a packed list per shard and bucket; a bucket sums the counts over the shards and
    tells each of them which of its patterns are frequent.  Only those are extended.

Counts are exact: words are compared as strings, patterns by the numbers of their words.
What a task holds is one shard, its text, dictionary and patterns, or one bucket, about
BUCKET_GRAMS patterns of shards; a pattern has one entry per shard there, however frequent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkweft.llm import words as W
from linkweft.llm.fm_index import DEPTH, Grams, Index, packed, transform, unpacked
from linkweft.llm.frames import written

SHARD_WORDS = 2_000_000
LEAST_COUNT = 30
PER_LANG = 2000
NO_LANG = "und"

# A phrase goes if a longer one around it has this share of its occurrences.
COVERED_PERCENT = 80
SCORE_UNITS = 2_000_000

# Entries of a bucket, at most on average; parts in which a language is ranked first.
BUCKET_GRAMS = 1_000_000
RANK_PARTS = 16

BREAKS = np.zeros(256, dtype=bool)
BREAKS[list(b".,;:!?\x0a\x0b\x0c\x0d")] = True
BLANKS = np.zeros(256, dtype=bool)
BLANKS[[0x20, 0x09]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

PARTS = ("w1", "w2", "w3", "w4")
SHARDS = "lang string, words array<string>, counts array<long>, text binary"
LISTS = "bucket long, shard long, symbols binary, n binary"
SUMS = "shard long, grams binary, n binary, occurrences long"
INDEXES = "shard long, symbols array<long>, forward binary, backward binary"


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST_COUNT, per_lang: int = PER_LANG, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first `per_lang` phrases of each language.

    Null texts are empty, a null language is "und"; languages differ as strings do.  Words
    are runs between blanks and tabs within pieces between `.,;:!?` and line ends, with A
    to Z in lower case.  Repeated rows count as often as they occur.  Ties of score and
    count are in byte order of the phrase.  Without rows, or without a phrase of `least`
    occurrences, the result is empty.  Further columns of `docs` are not read.
    """
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(f"`{text_col}`").alias("text"))
    shards = rows.mapInArrow(_shards(shard_words), SHARDS).withColumn("shard", F.monotonically_increasing_id())
    shards = written(shards, "phrase-shards")
    words, totals, grams = frequent_grams(shards, least)
    return ranked(words, totals, scored(words, grams), per_lang)


def frequent_grams(shards: DataFrame, least: int) -> tuple[DataFrame, DataFrame, dict[int, DataFrame]]:
    """Frequent words (lang, word, id, f); words per language; and the frequent patterns (w1, ..., f) of each length."""
    places = shards.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "x"))
    places = written(places.select("shard", "lang", "place", F.col("x.words").alias("word"), F.col("x.counts").alias("count")), "phrase-words")
    totals = places.groupBy("lang").agg(F.sum("count").alias("n"))
    words = places.groupBy("lang", "word").agg(F.sum("count").alias("f")).where(F.col("f") >= least)
    words = written(words.withColumn("id", F.monotonically_increasing_id()), "phrase-frequent-words")

    known = places.join(words.select("lang", "word", "id"), ["lang", "word"]).groupBy("shard").agg(F.collect_list(F.struct("place", "id")).alias("known"))
    indexes = written(shards.select("shard", "text").join(known, "shard").mapInArrow(_indexes, INDEXES), "phrase-indexes")

    grams: dict[int, DataFrame] = {}
    alive, occurrences = None, totals.agg(F.sum("n")).first()[0] or 0
    for length in range(2, DEPTH + 1):
        buckets = max(1, -(-occurrences // BUCKET_GRAMS))
        source = indexes if alive is None else indexes.join(alive, "shard")
        lists = source.mapInArrow(_extended(length, buckets), LISTS)
        sums = written(lists.groupBy("bucket").applyInArrow(_summed(length, least), SUMS), f"phrase-{length}-grams")
        parts = PARTS[:length]
        totals_of = sums.where("shard is null").select("grams", "n")
        grams[length] = written(totals_of.mapInArrow(_rows_of(length), f"{', '.join(f'{w} long' for w in parts)}, f long"), f"phrase-frequent-{length}-grams")
        here = sums.where("shard is not null")
        alive = here.groupBy("shard").agg(F.collect_list("grams").alias("alive"))
        # a pattern has at most as many extensions as it has occurrences
        occurrences = here.agg(F.sum("occurrences")).first()[0] or 0
    return words, totals, grams


def _score(a: Column, first: Column, rest: Column) -> Column:
    """floor(SCORE_UNITS * a / (first + rest)) in whole numbers of up to 38 digits."""
    scaled = a.cast("decimal(20,0)") * F.lit(SCORE_UNITS).cast("decimal(10,0)")
    whole = (first + rest).cast("decimal(20,0)")
    return ((scaled - scaled % whole) / whole).cast("long")


def scored(words: DataFrame, grams: dict[int, DataFrame]) -> DataFrame:
    """(w1 to w4, a, l, r, score) of the phrases that no longer phrase covers."""
    counts = {1: words.select(F.col("id").alias("w1"), "f")} | grams
    out = []
    for length, found in grams.items():
        parts = list(PARTS[:length])
        best = found.withColumnRenamed("f", "a")
        cuts = []
        for k in range(1, length):
            for name, of in ((f"l{k}", parts[:k]), (f"r{k}", parts[k:])):
                side = counts[len(of)].select(*[F.col(w).alias(v) for w, v in zip(PARTS, of)], F.col("f").alias(name))
                best = best.join(side, of)
            cuts.append(F.struct(_score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
        lowest = F.array_min(F.array(*cuts))
        best = best.select(*parts, "a", lowest.alias("cut"))
        around = [
            longer.select(*[F.col(PARTS[at + i]).alias(w) for i, w in enumerate(parts)], F.col("f").alias("around"))
            for size, longer in grams.items()
            for at in range(size - length + 1)
            if size > length
        ]
        if around:
            most = around[0]
            for more in around[1:]:
                most = most.unionByName(more)
            most = most.groupBy(*parts).agg(F.max("around").alias("around"))
            best = best.join(most, parts, "left").where(F.expr(f"around is null or cast(100 as decimal(10,0)) * around < cast({COVERED_PERCENT} as decimal(10,0)) * a"))
        out.append(best.select(*parts, *[F.lit(None).cast("long").alias(w) for w in PARTS[length:]], "a", "cut.l", "cut.r", "cut.score"))
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result


def ranked(words: DataFrame, totals: DataFrame, phrases: DataFrame, per_lang: int) -> DataFrame:
    spelled = phrases
    for w in PARTS:
        names = words.select(F.col("id").alias(w), F.col("word").alias(f"{w}_word"), *([F.col("lang")] if w == "w1" else []))
        spelled = spelled.join(names, w, "inner" if w in PARTS[:2] else "left")
    spelled = spelled.withColumn("phrase", F.concat_ws(" ", *[f"{w}_word" for w in PARTS]))
    best_first = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # each part of a language hands on its best, so one task gets RANK_PARTS * per_lang rows at most
    part = Window.partitionBy("lang", F.pmod(F.hash("phrase"), F.lit(RANK_PARTS))).orderBy(*best_first)
    spelled = spelled.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= per_lang)
    top = spelled.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best_first))).where(F.col("rank") <= per_lang)
    return top.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def split_pieces(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all words one after the other, their lengths, and whether a word begins a piece."""
    data, offsets = W.text_bytes(texts)
    data = LOWER[data]
    breaks = BREAKS[data]
    inside = ~(breaks | BLANKS[data])
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    stops[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    piece = np.cumsum(breaks)[starts] + np.searchsorted(offsets, starts, side="right")
    return data[inside], ends - starts, np.concatenate([[True], piece[1:] != piece[:-1]]) if len(starts) else np.zeros(0, dtype=bool)


class _Shard:
    """Words of one language, gathered until there are enough for a shard."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n = 0

    def add(self, texts: pa.Array) -> None:
        part = split_pieces(texts)
        if len(part[1]):
            self.parts.append(part)
            self.n += len(part[1])

    def row(self, lang: str) -> pa.RecordBatch:
        data, lengths, new = (np.concatenate([p[k] for p in self.parts]) for k in range(3))
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        spelled = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
        coded = spelled.dictionary_encode()
        number = coded.indices.to_numpy().astype(np.int64)
        text = np.zeros(len(number) + int(new.sum()), dtype=np.int32)
        text[np.arange(len(number)) + np.cumsum(new)] = number + 1
        names = coded.dictionary.cast(pa.large_string()).cast(pa.string())
        counts = np.bincount(number, minlength=len(names))
        one = pa.array([0, len(names)], pa.int32())
        columns = [pa.array([lang]), pa.ListArray.from_arrays(one, names), pa.ListArray.from_arrays(one, pa.array(counts)), pa.array([packed(text)], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["lang", "words", "counts", "text"])


def _shards(limit: int):
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_shards: dict[str, _Shard] = {}
        for batch in W.slices(batches, "text"):
            coded = batch.column("lang").dictionary_encode()
            numbers = coded.indices.to_numpy()
            for k, lang in enumerate(coded.dictionary.to_pylist()):
                shard = open_shards.setdefault(lang, _Shard())
                shard.add(batch.column("text").take(pa.array(np.flatnonzero(numbers == k))))
                if shard.n >= limit:
                    yield open_shards.pop(lang).row(lang)
            # many languages: the largest go first, so that a task holds two shards at most
            while sum(s.n for s in open_shards.values()) > 2 * limit:
                lang = max(open_shards, key=lambda x: open_shards[x].n)
                yield open_shards.pop(lang).row(lang)
        for lang, shard in open_shards.items():
            if shard.n:
                yield shard.row(lang)

    return shards


def _indexes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for d in range(batch.num_rows):
            known = batch.column("known")[d].values
            place, ids = known.field("place").to_numpy(), known.field("id").to_numpy()
            text = unpacked(batch.column("text")[d].as_py())
            symbol = np.zeros(int(max(text.max(), place.max() + 1)) + 1, dtype=np.int32)
            symbol[place + 1] = np.arange(1, len(place) + 1)
            text = np.concatenate([[0], symbol[text], [0]]).astype(np.int32)
            # words without a neighbour and repeated breaks are of no use
            word = text > 0
            beside = np.zeros(len(text), dtype=bool)
            beside[1:-1] = word[:-2] | word[2:]
            kept = word & beside
            kept[1:] |= kept[:-1] & ~word[1:]
            text = np.concatenate([[0], text[kept]]).astype(np.int32)
            used = np.unique(text)
            used = used[used > 0]
            if not len(used):
                continue
            text = np.where(text > 0, np.searchsorted(used, text) + 1, 0).astype(np.int32)
            columns = [batch.column("shard").slice(d, 1), pa.array([ids[used - 1]], pa.list_(pa.int64())), pa.array([packed(transform(text))], pa.binary()), pa.array([packed(transform(text[::-1]))], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "symbols", "forward", "backward"])


def _keys(symbols: np.ndarray, base: int) -> np.ndarray:
    """One number per row of at most three symbols."""
    key = symbols[:, 0]
    for k in range(1, symbols.shape[1]):
        key = key * base + symbols[:, k]
    return key


def _unpacked_grams(data: bytes, length: int) -> np.ndarray:
    """One row of word numbers per pattern; they are packed column by column."""
    return unpacked(data).reshape(length, -1).T


def _extended(length: int, buckets: int):
    """Lists of patterns of `length` words per bucket, made from the frequent ones that are a word shorter."""

    def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d in range(batch.num_rows):
                ids = batch.column("symbols")[d].values.to_numpy()
                index = Index(unpacked(batch.column("forward")[d].as_py()), unpacked(batch.column("backward")[d].as_py()), len(ids))
                if length == 2:
                    found = index.left(index.words())
                else:
                    order = np.argsort(ids)
                    known = np.concatenate([_unpacked_grams(x, length - 1) for x in batch.column("alive")[d].as_py()])
                    found = _longer(index, order[np.searchsorted(ids, known, sorter=order)] + 1, len(ids) + 1)
                grams = ids[found.symbols - 1]
                bucket = np.zeros(len(grams), dtype=np.uint64)
                for k in range(length):
                    bucket = W.mix(bucket ^ grams[:, k].astype(np.uint64) + np.uint64(k + 1))
                bucket = (bucket % np.uint64(buckets)).astype(np.int64)
                order = np.lexsort((*grams.T[::-1], bucket))
                grams, size, bucket = grams[order], found.size[order], bucket[order]
                edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else [0]
                spans = list(zip(edges[:-1], edges[1:]))
                columns = [
                    pa.array(bucket[edges[:-1]], pa.int64()),
                    pa.repeat(batch.column("shard")[d], len(spans)),
                    pa.array([packed(grams[a:b].T) for a, b in spans], pa.binary()),
                    pa.array([packed(size[a:b]) for a, b in spans], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "shard", "symbols", "n"])

    return extended


def _summed(length: int, least: int):
    """The frequent patterns of a bucket with their counts, and for each shard those it has."""

    def summed(lists: pa.Table) -> pa.Table:
        shards = lists.column("shard").to_numpy()
        parts = [_unpacked_grams(x, length) for x in lists.column("symbols").to_pylist()]
        grams, counts = np.concatenate(parts), np.concatenate([unpacked(x) for x in lists.column("n").to_pylist()])
        ends = np.cumsum([len(x) for x in parts])
        order = np.lexsort(grams.T[::-1])
        grams = grams[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (grams[1:] != grams[:-1]).any(axis=1)
        at = np.flatnonzero(new)
        total = np.add.reduceat(counts[order], at)
        frequent = total >= least
        alive = np.zeros(len(order), dtype=bool)
        alive[order] = frequent[np.cumsum(new) - 1]
        rows = [(None, packed(grams[at[frequent]].T), packed(total[frequent]), None)] if frequent.any() else []
        for shard, part, to in zip(shards.tolist(), parts, ends):
            kept = alive[to - len(part) : to]
            if kept.any():
                rows.append((shard, packed(part[kept].T), None, int(counts[to - len(part) : to][kept].sum())))
        kinds = {"shard": pa.int64(), "grams": pa.binary(), "n": pa.binary(), "occurrences": pa.int64()}
        return pa.table({name: pa.array([r[k] for r in rows], kind) for k, (name, kind) in enumerate(kinds.items())})

    return summed


def _rows_of(length: int):
    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d in range(batch.num_rows):
                grams = _unpacked_grams(batch.column("grams")[d].as_py(), length)
                columns = [pa.array(np.ascontiguousarray(grams[:, k])) for k in range(length)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(unpacked(batch.column("n")[d].as_py()))], [*PARTS[:length], "f"])

    return rows_of


def _longer(index: Index, alive: np.ndarray, base: int) -> Grams:
    """One-word extensions of the patterns `alive`, whose other part of that length is alive, too."""
    keys = np.unique(_keys(alive, base))
    pairs = index.left(index.words())
    if alive.shape[1] == 2:
        pairs = pairs.take(np.flatnonzero(np.isin(_keys(pairs.symbols, base), keys)))
        found = index.right(pairs)
        return found.take(np.flatnonzero(np.isin(_keys(found.symbols[:, 1:], base), keys)))
    pairs = pairs.take(np.flatnonzero(np.isin(_keys(pairs.symbols, base), _keys(alive[:, :2], base))))
    triples = index.right(pairs)
    triples = triples.take(np.flatnonzero(np.isin(_keys(triples.symbols, base), keys)))
    found = index.left(triples)
    return found.take(np.flatnonzero(np.isin(_keys(found.symbols[:, :-1], base), keys)))

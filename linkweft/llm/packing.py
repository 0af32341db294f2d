"""Best-fit packing of token sequences, after Martello-Toth dominance reduction.

What a packing needs of the corpus is how many pieces of each length there are: at most
`capacity` numbers.  The plan is computed from this histogram, so its cost does not grow
with the corpus; the pieces are then dealt to their places in Spark by their rank among
the pieces of their length.

The reduction fixes sets which provably are in some best packing: a piece that nothing
fits with, a pair that fills a sequence, the largest partner where no two others fit, and
two or three pieces that dominate every other set with the largest piece.  The rest is
packed by best fit, largest first.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkweft.llm import words as W
from linkweft.llm.frames import written
from linkweft.llm.tokens import word_tokens

CAPACITY = 2048

# Pieces of one length that are ranked together.
RANKED_ROWS = 100_000

# (number of sequences, pieces of each as (length, how many))
Group = tuple[int, tuple[tuple[int, int], ...]]


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids) of every document.

    The ids of a document are those of its whole text, then `end_id`; a null or empty text
    gives `end_id` alone.  Documents over `capacity` ids are cut every `capacity` ids.
    Rows with equal or null ids are documents of their own.  Every executor needs the
    vocabulary file at `tokenizer_path`.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(tokenizer_path)
        for batch in W.slices(batches, "text"):
            flat, counts = tokens.encode(batch.column("text"))
            lengths = counts + 1
            ids = np.full(int(lengths.sum()), end_id, dtype="<u4")
            ids[np.arange(len(flat)) + np.repeat(np.arange(len(counts)), counts)] = flat
            parts = -(-lengths // capacity)
            owner = np.repeat(np.arange(len(parts)), parts)
            piece = W.ragged(np.zeros(len(parts), dtype=np.int64), parts)
            start = piece * capacity
            length = np.minimum(lengths[owner] - start, capacity)
            at = (np.cumsum(lengths) - lengths)[owner] + start
            crc = [zlib.crc32(ids[a : a + n]) for a, n in zip(at, length)]
            offsets = pa.array(np.concatenate([at, [len(ids)]]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(owner)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(ids.view("<i4")))],
                ["doc_id", "piece", "start", "length", "ids_crc32", "ids"],
            )

    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>")


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`cut` with the place of each piece: sequence_id, offset (both long).

    Offsets of a sequence are gapless from 0, and no sequence holds over `capacity` ids.
    `cut` is read several times and must give the same rows each time: pass a written
    table.  Equal rows take different places.  An empty table stays empty.
    """
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    spark, total = cut.sparkSession, sum(counts.values())
    slots = spark.createDataFrame(_slots(plan(counts, capacity)), "slot_length long, from_rank long, to_rank long, first_sequence long, per_sequence long, first_offset long")
    keys = [c for c in cut.columns if c != "ids"]
    part = F.pmod(F.xxhash64(*keys), F.lit(-(-total // RANKED_ROWS) or 1)).cast("int")
    parted = cut.withColumn("_part", part)
    before = (
        parted.groupBy("length", "_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("length", "_part", (F.sum("_n").over(Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_before"))
    )
    within = F.row_number().over(Window.partitionBy("length", "_part").orderBy(*keys)) - 1
    ranked = parted.withColumn("_within", within).join(before, ["length", "_part"]).withColumn("_rank", F.col("_within") + F.col("_before"))
    place = F.col("_rank") - F.col("from_rank")
    return ranked.join(F.broadcast(slots), (F.col("length") == F.col("slot_length")) & (F.col("_rank") >= F.col("from_rank")) & (F.col("_rank") < F.col("to_rank"))).select(
        *cut.columns,
        (F.col("first_sequence") + F.floor(place / F.col("per_sequence"))).cast("long").alias("sequence_id"),
        (F.col("first_offset") + F.pmod(place, F.col("per_sequence")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of whole documents with their places; without the ids themselves."""
    cut = pieces(docs, tokenizer_path, capacity=capacity).drop("ids")
    return pack(written(cut, "pieces"), capacity)


def _slots(groups: list[Group]) -> list[tuple[int, int, int, int, int, int]]:
    """Ranks of each length that go to a group of sequences, and where they start.

    Every length has a few groups; there are some thousand rows at most, whatever the
    number of pieces.
    """
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for count, items in groups:
        offset = 0
        for length, many in items:
            first = used.get(length, 0)
            used[length] = first + count * many
            rows.append((length, first, first + count * many, sequence, many, offset))
            offset += length * many
        sequence += count
    return rows


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Group]:
    """Sequences for so many pieces of each length: the reduction, then best fit."""
    left = {k: int(v) for k, v in counts.items() if v}
    fixed = reduce_dominated(left, capacity)
    return fixed + best_fit(left, capacity)


def reduce_dominated(left: dict[int, int], capacity: int) -> list[Group]:
    """Fix sets that are in some best packing; takes their pieces out of `left`."""
    fixed: list[Group] = []
    for large in sorted(left, reverse=True):
        while left.get(large):
            chosen = _dominating(left, large, capacity)
            if chosen is None:
                break
            times = min(left[length] // chosen.count(length) for length in set(chosen))
            fixed.append((times, tuple((length, chosen.count(length)) for length in sorted(set(chosen), reverse=True))))
            for length in chosen:
                left[length] -= times
            for length in set(chosen):
                if not left[length]:
                    del left[length]
    return fixed


def _dominating(left: dict[int, int], large: int, capacity: int) -> list[int] | None:
    """A set with `large` that dominates all other sets with it, if there is one we can tell."""
    rest = capacity - large
    own = left[large] - 1
    sizes = sorted(k for k in left if k <= rest and (k != large or own))
    if not sizes:
        return [large]
    most = sizes[-1]
    have = lambda k: own if k == large else left[k]
    if most == rest:
        return [large, most]
    smallest = [k for k in sizes[:3] for _ in range(min(3, have(k)))][:3]
    if len(smallest) < 2 or smallest[0] + smallest[1] > rest:
        return [large, most]
    if len(smallest) == 3 and sum(smallest) <= rest:
        return None
    # No three others fit: compare with the pairs that do.
    best_sum, best_second = 0, 0
    for k in sizes:
        i = bisect.bisect_right(sizes, rest - k) - 1
        if i >= 0 and sizes[i] == k and have(k) < 2:
            i -= 1
        if i >= 0:
            best_sum = max(best_sum, k + sizes[i])
            best_second = max(best_second, min(k, sizes[i]))
    if most >= best_sum:
        return [large, most]
    i = bisect.bisect_right(sizes, rest - most) - 1
    if i >= 0 and sizes[i] == most and have(most) < 2:
        i -= 1
    if i >= 0 and sizes[i] >= best_second:
        return [large, most, sizes[i]]
    return None


def best_fit(left: dict[int, int], capacity: int) -> list[Group]:
    """Largest first, each piece into the fullest sequence it fits; equal steps at once."""
    open_at: list[int] = []
    groups: dict[int, list[Group]] = {}

    def put(room: int, group: Group) -> None:
        if room not in groups:
            bisect.insort(open_at, room)
            groups[room] = []
        groups[room].append(group)

    for length in sorted(left, reverse=True):
        many = left[length]
        while many:
            i = bisect.bisect_left(open_at, length)
            if i == len(open_at):
                each = capacity // length
                full, over = divmod(many, each)
                if full:
                    put(capacity - each * length, (full, ((length, each),)))
                if over:
                    put(capacity - over * length, (1, ((length, over),)))
                break
            room = open_at[i]
            count, items = groups[room].pop()
            if not groups[room]:
                del groups[room], open_at[i]
            each = room // length
            full = min(count, many // each)
            if full:
                put(room - each * length, (full, (*items, (length, each))))
                many -= full * each
                count -= full
            if count and 0 < many < each:
                put(room - many * length, (1, (*items, (length, many))))
                many, count = 0, count - 1
            if count:
                put(room, (count, items))
    return [g for room in open_at for g in groups[room]]

"""Near-duplicate classes by DartMinHash signatures and banded joining.

A text is a weighted set: its shingles of five words, each weighing as often as it occurs.
DartMinHash throws darts, placed by hashes alone, into the region of each element: every
unit of weight by every unit of rank has Poisson(1) darts, each with a coordinate of the
signature and a rank.  The earliest dart of each coordinate is kept, so two texts agree in
a coordinate with the probability of their weighted Jaccard similarity, and a text costs
darts in proportion to the signature plus its length, not to their product.  A text that
repeats shingles has a second signature, in which each of them weighs one, and so its
agreement is the plain Jaccard similarity; of any other text both are the same.

Bands of the signatures are joined in Spark:

1.  Texts with the same shingles, each as often, are one node.
2.  In each band bucket all nodes are compared with one leader, the node with the most
    neighbours, and components of the links are taken.
3.  Buckets that still span several components compare all pairs of nodes from
    different components, in blocks of bounded size, and the components are taken again.

So every pair of different texts that shares a bucket is either compared or in one class
already, and no task takes more of a bucket than a block.  Rows of step 2 grow with the
buckets' sizes; those of step 3 with nodes times nodes outside the largest component,
divided by the blocks.  With 24 bands of 5 coordinates a pair at similarity 0.8, be
it the weighted or the plain one, shares a bucket with probability 0.9999.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkweft.llm import words as W
from linkweft.llm.components import components
from linkweft.llm.frames import written

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
COORDINATES = BANDS * ROWS

# Pairs are compared shingle by shingle from this share of equal signature bytes on: four
# standard deviations below the similarity, and accidental equality of a byte ignored.
LEAST_SHARE = SIMILARITY - 4 * (SIMILARITY * (1 - SIMILARITY) / COORDINATES) ** 0.5

# Bytes of a signature column: the weighted signature, then the plain one if it is another.
WEIGHTED, PLAIN = slice(0, COORDINATES), slice(-COORDINATES, None)

# Texts sketched at once: each takes at least COORDINATES * (log(COORDINATES) + 2) cells, however short.
STEP_TEXTS = 1000

# Most nodes of a bucket on the two sides of one block.
LEFT_BLOCK, RIGHT_BLOCK = 256, 4096

# Chances of at most 0, 1, ... darts in a region of area one: the Poisson distribution.
_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod(np.concatenate([[1.0], np.arange(1, 18)])))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id): the class of every row, named by its least doc_id.

    Two texts are linked if the weighted or the plain Jaccard similarity of their
    shingles is 0.8 or more; classes are the components of the links.  Words are runs between ASCII white
    space, unchanged; a text of one to four words is one shingle.  Null and empty texts
    are equal to each other.  Rows with a null id are in a class with equal texts only, or,
    where no row of the class has an id, in a class named null.  Rows with equal ids are
    nodes of their own, unless their shingles and the counts of these are equal.
    """
    return _classes(docs, id_col, text_col).drop("copy")


def _classes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`near_duplicates` with `copy`, the hash of a row's text, which tells rows of one id apart."""
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("copy"), text.alias("text"))
    sketches = written(rows.mapInArrow(_sketches, "id long, copy long, node binary, signature binary, bands array<long>"), "sketches")
    # the least id of a node, with what was made of its text; a null id only if there is no other
    named = F.struct(F.col("id").isNull().alias("unnamed"), "id", "signature", "bands")
    nodes = written(sketches.groupBy("node").agg(F.min(named).alias("x")).select("node", "x.id", "x.signature", "x.bands"), "nodes")
    found = _labels(rows, nodes)
    labels = nodes.select("node", "id")
    labels = labels.withColumn("label", F.col("node")) if found is None else labels.join(found, "node", "left").select("node", "id", F.coalesce("label", "node").alias("label"))
    labels = written(labels, "labels")
    class_ids = written(labels.groupBy("label").agg(F.min("id").alias("class_id")), "class-ids")
    classes = written(labels.join(class_ids, "label").select("node", "class_id"), "classes")
    return sketches.select(F.col("id").alias("doc_id"), "copy", "node").join(classes, "node").select("doc_id", "copy", "class_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose id names their class: one document of each group.

    Of several texts with that id in the class one stays; the id's texts in other classes
    stay only where they name these.  Rows with the same id and text are kept once.  Rows
    with a null id all stay, as no decision can name them.  Input columns may have any names.
    """
    found = _classes(docs, id_col, text_col).where("doc_id = class_id")
    kept = written(found.groupBy("doc_id").agg(F.min("copy").alias("copy")), "kept-rows")
    own_id = F.col(f"`{id_col}`")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), own_id.cast("long").alias("doc_id"), F.xxhash64(F.col(f"`{text_col}`")).alias("copy"))
    number = F.row_number().over(Window.partitionBy("doc_id", "copy").orderBy(F.lit(0)))
    named = rows.join(kept, ["doc_id", "copy"], "left_semi").withColumn("number", number).where("number = 1")
    return named.select("row.*").unionByName(docs.where(own_id.isNull()))


def _labels(rows: DataFrame, nodes: DataFrame) -> DataFrame | None:
    """(node, label) of linked nodes, or None without links.

    Each step is written, so that no later one repeats it, and tables of few rows are
    small enough for Spark to join them without a shuffle.
    """
    buckets = nodes.where("id is not null").select("node", F.explode("bands").alias("bucket"))
    shared = written(buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "shared-buckets")
    members = written(buckets.join(shared, "bucket"), "bucket-members")
    if members.isEmpty():
        return None
    central = written(members.groupBy("node").agg(F.sum("size").alias("neighbours")), "neighbours")
    contents = _contents(rows, nodes.join(central, "node").select("node", "id", "signature"))

    # in each bucket all nodes meet the one with the most neighbours
    most = F.max(F.struct("neighbours", "node"))
    leaders = written(members.join(central, "node").groupBy("bucket").agg(most.alias("x")).select("bucket", F.col("x.node").alias("leader"), F.ceil(F.col("x.neighbours") / RIGHT_BLOCK).cast("int").alias("parts")), "leaders")
    pairs = members.join(leaders, "bucket").where("node <> leader").select("leader", "parts", "node").distinct()
    right = pairs.select(F.col("leader").alias("place"), F.lit(0).alias("left_part"), F.pmod(F.hash("node"), F.col("parts")).alias("right_part"), "node", F.col("node").alias("label"))
    left = leaders.select("leader", "parts").distinct().select(F.col("leader").alias("place"), F.lit(0).alias("left_part"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("right_part"), F.col("leader").alias("node"), F.col("leader").alias("label"))
    links = written(_compare(left, right, contents), "leader-links")
    first = None if links.isEmpty() else written(components(links), "first-labels")

    # buckets that hold several components: all pairs of nodes from different ones, in blocks
    labelled = members.select("bucket", "node")
    labelled = labelled.withColumn("label", F.col("node")) if first is None else labelled.join(first, "node", "left").select("bucket", "node", F.coalesce("label", "node").alias("label"))
    labelled = written(labelled, "labelled-members")
    parts = labelled.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = parts.groupBy("bucket").agg(F.max(F.struct("n", "label")).alias("most"), F.sum("n").alias("size"), F.count(F.lit(1)).alias("labels")).where("labels > 1")
    mixed = written(
        mixed.select(
            "bucket",
            F.col("most.label").alias("main"),
            F.ceil((F.col("size") - F.col("most.n")) / LEFT_BLOCK).cast("int").alias("left_parts"),
            F.ceil(F.col("size") / RIGHT_BLOCK).cast("int").alias("right_parts"),
        ),
        "mixed-buckets",
    )
    here = written(labelled.join(mixed, "bucket").withColumn("place", F.col("bucket").cast("string").cast("binary")), "mixed-members")
    left = here.where("label <> main").select("place", F.pmod(F.hash("node"), F.col("left_parts")).alias("left_part"), F.explode(F.sequence(F.lit(0), F.col("right_parts") - 1)).alias("right_part"), "node", "label")
    right = here.select("place", F.explode(F.sequence(F.lit(0), F.col("left_parts") - 1)).alias("left_part"), F.pmod(F.hash("node"), F.col("right_parts")).alias("right_part"), "node", "label")
    more = written(_compare(left, right, contents, "label"), "block-links")
    if more.isEmpty():
        return first
    # these links join whole components
    second = written(components(more), "second-labels")
    if first is None:
        return second
    joined = second.select(F.col("node").alias("label"), F.col("label").alias("joined"))
    alone = second.join(first.select(F.col("label").alias("node")).distinct(), "node", "left_anti")
    return first.join(joined, "label", "left").select("node", F.coalesce("joined", "label").alias("label")).unionByName(alone)


def _contents(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, signature, first, more): the shingles of every node that is in a shared bucket."""
    texts = rows.join(wanted.withColumnRenamed("id", "wanted_id"), F.col("id") == F.col("wanted_id")).select("node", "signature", "text")
    return written(texts.mapInArrow(_shingle_sets, "node binary, signature binary, first binary, more binary"), "shingle-sets")


def _compare(left: DataFrame, right: DataFrame, contents: DataFrame, ends: str = "node") -> DataFrame:
    """(a, b) of linked nodes with different labels on the two sides of a block, or of their labels."""
    keys = ["place", "left_part", "right_part"]
    columns = [*keys, "node", "label", "signature", "first", "more"]
    # toDF renews the columns: both sides come from the same tables.
    sides = [side.join(contents, "node").select(*columns).toDF(*columns) for side in (left, right)]

    def links(one: pa.Table, other: pa.Table) -> pa.Table:
        return _links(one, other, ends)

    return sides[0].groupBy(*keys).cogroup(sides[1].groupBy(*keys)).applyInArrow(links, "a binary, b binary")


def _links(left: pa.Table, right: pa.Table, ends: str) -> pa.Table:
    pairs = []
    if left.num_rows and right.num_rows:
        signed = [t.column("signature").to_pylist() for t in (left, right)]
        marks, plain = [[np.frombuffer(b"".join(x[part] for x in side), np.uint8).reshape(-1, COORDINATES) for side in signed] for part in (WEIGHTED, PLAIN)]
        repeating = [np.array([len(x) > COORDINATES for x in side]) for side in signed]
        names = [t.column(ends).to_pylist() for t in (left, right)]
        labels = [t.column("label").to_pylist() for t in (left, right)]
        shingles = [[[np.frombuffer(x, np.uint64) for x in t.column(c).to_pylist()] for c in ("first", "more")] for t in (left, right)]
        for i, own in enumerate(labels[0]):
            share = (marks[1] == marks[0][i]).mean(axis=1)
            # without repeats on either side the plain share is the same
            other = slice(None) if repeating[0][i] else np.flatnonzero(repeating[1])
            share[other] = np.maximum(share[other], (plain[1][other] == plain[0][i]).mean(axis=1))
            joined = {own}
            for j in np.flatnonzero(share >= LEAST_SHARE):
                if labels[1][j] not in joined and _similar(shingles[0][0][i], shingles[0][1][i], shingles[1][0][j], shingles[1][1][j]):
                    joined.add(labels[1][j])
                    pairs.append((min(names[0][i], names[1][j]), max(names[0][i], names[1][j])))
    return pa.table({"a": pa.array([p[0] for p in pairs], pa.binary()), "b": pa.array([p[1] for p in pairs], pa.binary())})


def _similar(first: np.ndarray, more: np.ndarray, other_first: np.ndarray, other_more: np.ndarray) -> bool:
    """Whether the plain or the weighted Jaccard similarity reaches the limit."""
    plain = _common(first, other_first)
    if plain >= SIMILARITY * (len(first) + len(other_first) - plain):
        return True
    weighted = plain + _common(more, other_more)
    total = len(first) + len(more) + len(other_first) + len(other_more)
    return weighted >= SIMILARITY * (total - weighted)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    if not len(a) or not len(b):
        return 0
    at = np.searchsorted(a, b)
    return int((a[np.minimum(at, len(a) - 1)] == b).sum())


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hash, count) of the distinct shingles of every text, in text order."""
    words = W.split(texts)
    h, counts = W.hashes(words), words.counts
    at = W.inside_text(words, SHINGLE)
    owner, values = words.text_of()[at], W.mix(W.windows(h, SHINGLE)[at])
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    whole = np.array([_whole(h[words.first[d] : words.first[d + 1]]) for d in short], dtype=np.uint64)
    owner, values = np.concatenate([owner, short]), np.concatenate([values, whole])
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])
    at = np.flatnonzero(new)
    return owner[at], values[at], np.diff(np.concatenate([at, [len(owner)]]))


def _whole(h: np.ndarray) -> np.uint64:
    return W.mix(W.windows(h, len(h)) + np.uint64(len(h)))[0]


def _units(owner: np.ndarray, values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row per unit of weight: text, hash of shingle and unit, number of the unit."""
    unit = W.ragged(np.zeros(len(counts), dtype=np.int64), counts)
    who = np.repeat(np.arange(len(counts)), counts)
    return owner[who], np.where(unit == 0, values[who], W.mix(values[who] + unit.astype(np.uint64) * W.MIX2)), unit


def _node_of(values: np.ndarray, counts: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes() + counts.astype(np.int64).tobytes(), digest_size=16).digest()


def signatures(owner: np.ndarray, units: np.ndarray, n_texts: int, coordinates: int = COORDINATES) -> np.ndarray:
    """The earliest dart of every coordinate for texts given by their units; no text is empty."""
    out = np.zeros((n_texts, coordinates), dtype=np.uint64)
    expected = coordinates * (np.log(coordinates) + 2)
    todo, depth = np.arange(n_texts), 1
    while len(todo):
        inside = np.isin(owner, todo)
        who, unit = np.searchsorted(todo, owner[inside]), units[inside]
        size = np.bincount(who, minlength=len(todo))
        ranks = np.ceil(depth * expected / size).astype(np.int64)
        cells = ranks[who]
        rank = W.ragged(np.zeros(len(cells), dtype=np.int64), cells)
        who, unit = np.repeat(who, cells), np.repeat(unit, cells)
        region = W.mix(unit + (rank.astype(np.uint64) + np.uint64(1)) * W.MIX)
        darts = np.searchsorted(_POISSON, (region >> np.uint64(11)) / float(1 << 53), side="right")
        number = W.ragged(np.zeros(len(darts), dtype=np.int64), darts)
        who, rank = np.repeat(who, darts), np.repeat(rank, darts)
        dart = W.mix(np.repeat(region, darts) ^ ((number.astype(np.uint64) + np.uint64(1)) * W.MIX2))
        place = who * coordinates + ((dart >> np.uint64(32)) % np.uint64(coordinates)).astype(np.int64)
        order = np.lexsort((dart & np.uint64(0xFFFFFFFF), rank, place))
        place, dart = place[order], dart[order]
        first = np.ones(len(place), dtype=bool)
        first[1:] = place[1:] != place[:-1]
        filled = np.zeros(len(todo) * coordinates, dtype=bool)
        filled[place[first]] = True
        kept = np.zeros(len(todo) * coordinates, dtype=np.uint64)
        kept[place[first]] = dart[first]
        out[todo] = kept.reshape(-1, coordinates)
        todo = todo[~filled.reshape(-1, coordinates).all(axis=1)]
        depth *= 2
    return out


def _banded(made: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last byte of every coordinate, and the buckets, of each signature."""
    bands = np.zeros((len(made), BANDS), dtype=np.uint64)
    for band in range(BANDS):
        h = np.full(len(made), band + 1, dtype=np.uint64)
        for row in range(ROWS):
            h = W.mix(h ^ made[:, band * ROWS + row])
        bands[:, band] = h
    return (made & np.uint64(0xFF)).astype(np.uint8), bands.view(np.int64)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    steps = (piece.slice(at, STEP_TEXTS) for piece in W.slices(batches, "text") for at in range(0, piece.num_rows, STEP_TEXTS))
    for batch in steps:
        owner, values, counts = shingles(batch.column("text"))
        bounds = np.searchsorted(owner, np.arange(batch.num_rows + 1))
        node = [_node_of(values[a:b], counts[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
        full = np.flatnonzero(np.diff(bounds))
        place = np.searchsorted(full, owner)
        who, units, _ = _units(place, values, counts)
        marks, bands = _banded(signatures(who, units, len(full)))
        signature, band_lists = [None] * batch.num_rows, [[]] * batch.num_rows
        for k, d in enumerate(full):
            signature[d], band_lists[d] = marks[k].tobytes(), bands[k]
        # texts that repeat shingles are in the buckets of their plain signature, too
        repeating = np.unique(place[counts > 1])
        if len(repeating):
            own = np.isin(place, repeating)
            marks, bands = _banded(signatures(np.searchsorted(repeating, place[own]), values[own], len(repeating)))
            for k, d in enumerate(full[repeating]):
                signature[d] += marks[k].tobytes()
                band_lists[d] = np.union1d(band_lists[d], bands[k])
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("copy"), pa.array(node, pa.binary()), pa.array(signature, pa.binary()), pa.array(band_lists, pa.list_(pa.int64()))],
            ["id", "copy", "node", "signature", "bands"],
        )


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.slices(batches, "text"):
        owner, values, counts = shingles(batch.column("text"))
        bounds = np.searchsorted(owner, np.arange(batch.num_rows + 1))
        rows = []
        for d, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            if _node_of(values[a:b], counts[a:b]) == batch.column("node")[d].as_py():
                _, units, unit = _units(owner[a:b], values[a:b], counts[a:b])
                rows.append((batch.column("node")[d].as_py(), batch.column("signature")[d].as_py(), values[a:b].tobytes(), np.sort(units[unit > 0]).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.binary()) for k in range(4)], ["node", "signature", "first", "more"])


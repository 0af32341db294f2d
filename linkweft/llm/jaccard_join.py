"""Similarity join of texts on their word n-gram sets, and the components of its links.

Texts are sets of five-word shingles; two link when their Jaccard similarity is 0.8 or more.

1.  Texts with equal sets are one node.
2.  A screen drops nodes without a partner: in hash order the first shingles of a set are
    unshared in at most the number that two linked sets may differ by.
3.  The shingles of the other nodes are counted, and each node keeps its prefix, the rarest
    ones: linked sets share a shingle of their prefixes.  Nodes with a common prefix shingle
    are a bucket.
4.  In every bucket the nodes meet one leader.  A pair that passes the length, positional
    and suffix filter is verified once, whatever the number of its buckets; components of
    the links are classes.
5.  Buckets that then hold several classes: pairs of nodes of different classes that pass
    the filters make candidate groups, which are disjoint, so that each pair is in one
    group at most.  All such pairs of a group are verified once, in blocks of bounded size.

Pairs within one class need no verification, as their link changes no component; so copies
are never expanded into all pairs, and no link between different classes is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweft.llm import words as W
from linkweft.llm.components import components
from linkweft.llm.frames import written

SHINGLE = 5
# Least similarity, in hundredths.
PERCENT = 80

# Shingles beyond the prefix which the screen looks at, in hundredths of the set.  All but
# (100 - PERCENT) % of these must be shared, which few nodes without partner meet by chance.
SCREEN_MORE = 10

# Hash ranges in which the suffix filter counts shingles.
CELLS = 256

# Most nodes on one side of a block of the filters, and shingles on one side of a block that verifies.
FILTER_BLOCK = 4096
VERIFY_SHINGLES = 1_000_000

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    A to Z are lower-cased, words are runs between ASCII white space.  A set is the distinct
    shingles of five words; of a text with fewer words its whole sequence; a null text and
    one without words have the empty set, which links with nothing.  component_id is the
    least doc_id reachable by links, the own one included.  Rows with equal sets are linked,
    also rows with the same id; rows with the same id are nodes of their own where their
    sets differ.  A null id is greater than all others: a row without id gets the least id
    of its component, or null if that has none.  An empty table gives an empty result.
    Further columns are not read.
    """
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    sets = written(rows.mapInArrow(_sets, "id long, text_key long, node binary, size long"), "shingle-sets")
    named = F.struct(F.col("id").isNull().alias("unnamed"), "id", "text_key")
    nodes = sets.where("size > 0").groupBy("node").agg(F.min(named).alias("x"), F.first("size").alias("size"))
    nodes = written(nodes.select("node", "x.id", "x.text_key", "size"), "jaccard-nodes")
    found = linked_nodes(rows, nodes)
    if found is None:
        classes = nodes.select("node", F.col("id").alias("component_id"))
    else:
        labels = nodes.join(found, "node", "left").select("node", "id", F.coalesce("label", "node").alias("label"))
        labels = written(labels, "jaccard-labels")
        least = labels.groupBy("label").agg(F.min("id").alias("component_id"))
        classes = written(labels.join(least, "label").select("node", "component_id"), "jaccard-classes")
    full = sets.where("size > 0").join(classes, "node").select(F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), "component_id")
    empty = sets.where("size = 0").select(F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), F.col("id").alias("component_id"))
    return full.unionByName(empty)


def linked_nodes(rows: DataFrame, nodes: DataFrame) -> DataFrame | None:
    """(node, label) of the nodes that have a link; None if there are no links."""
    active = _screened(rows, nodes)
    contents = written(_of_nodes(rows, active).mapInArrow(_contents, "node binary, size long, shingles binary"), "jaccard-contents")
    members = _prefix_members(contents)
    if members.isEmpty():
        return None
    profiles = contents.join(members.select("node").distinct(), "node", "left_semi")
    profiles = written(profiles.mapInArrow(_profiles, "node binary, size long, shingles binary, cells binary"), "jaccard-profiles")

    links = written(_verified(_leader_sides(members, profiles), profiles), "jaccard-leader-links")
    first = None if links.isEmpty() else written(components(links), "jaccard-first-labels")
    labelled = members.withColumn("label", F.col("node")) if first is None else members.join(first, "node", "left").withColumn("label", F.coalesce("label", "node"))
    labelled = written(labelled, "jaccard-labelled-members")

    stars = written(_candidate_stars(labelled, profiles), "jaccard-candidates")
    if stars.isEmpty():
        return first
    groups = written(components(stars), "jaccard-candidate-groups")
    more = written(_verified(_group_sides(groups, labelled, profiles), profiles, by_label=True), "jaccard-group-links")
    if more.isEmpty():
        return first
    # these links join whole classes
    second = written(components(more), "jaccard-second-labels")
    if first is None:
        return second
    joined = second.select(F.col("node").alias("label"), F.col("label").alias("joined"))
    alone = second.join(first.select(F.col("label").alias("node")).distinct(), "node", "left_anti")
    return first.join(joined, "label", "left").select("node", F.coalesce("joined", "label").alias("label")).unionByName(alone)


def _screened(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nodes (node, id, size) of whose first shingles in hash order enough are in another node, too."""
    # a key of 64 bits stands for a node: two linked nodes with one key, of which one would be lost, are not to be expected
    entries = rows.mapInArrow(_screen_entries, "shingle long, key long")
    shared = entries.groupBy("shingle").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low < high").select("shingle")
    shared = written(shared, "jaccard-shared")
    hits = entries.join(shared, "shingle").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("hits"))
    keyed = nodes.withColumn("key", _key_of(F.col("node")))
    # Of two linked sets, take the one whose screened shingles end at the lower hash: at most
    # size - needed of these are not in the other, so 1 + its further shingles are, and the
    # other has them screened, too.  Its size is at least what the other needs.
    enough = F.col("hits") > F.expr(f"{SCREEN_MORE} * (({PERCENT} * size + 99) div 100) div 100")
    return written(keyed.join(hits, "key").where(enough).select("node", "id", "text_key"), "jaccard-active")


def _needed(size: str):
    """Least number of shingles that a set of this size shares with a linked one."""
    return F.expr(f"({PERCENT} * {size} + 99) div 100")


def _key_of(node):
    return F.conv(F.hex(F.substring(node, 1, 8)), 16, -10).cast("long")


def _of_nodes(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """One text of each node, found by its id and a hash; repeated rows are combined before the move."""
    wanted = nodes.select("node", F.col("id").alias("wanted_id"), F.col("text_key").alias("wanted_key"))
    texts = rows.groupBy("id", "text_key").agg(F.first("text").alias("text"))
    return texts.join(wanted, F.col("id").eqNullSafe(F.col("wanted_id")) & (F.col("text_key") == F.col("wanted_key"))).select("node", "text")


def _prefix_members(contents: DataFrame) -> DataFrame:
    """(shingle, node, size, place): the prefix of each node, the shingles that one node has left out."""
    entries = contents.mapInArrow(_exploded, "shingle long, node binary, size long")
    counts = written(entries.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "jaccard-counts")
    shared = entries.join(counts, "shingle").groupBy("node", "size").agg(F.array_sort(F.collect_list(F.struct("n", "shingle"))).alias("order"))
    # unshared shingles come first in the prefix
    alone = F.col("size") - F.size("order")
    kept = F.col("size") - _needed("size") + 1 - alone
    prefix = shared.withColumn("alone", alone).withColumn("kept", kept.cast("int")).where("kept > 0")
    prefix = prefix.select("node", "size", "alone", F.posexplode(F.slice("order", F.lit(1), F.col("kept"))).alias("at", "x"))
    members = written(prefix.select(F.col("x.shingle").alias("shingle"), "node", "size", (F.col("alone") + F.col("at")).alias("place")), "jaccard-prefixes")
    several = members.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("shingle")
    return written(members.join(several, "shingle"), "jaccard-members")


def _leader_sides(members: DataFrame, profiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaders and the nodes that share a bucket with them, as sides of blocks; every pair once."""
    sizes = members.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    central = written(members.join(sizes, "shingle").groupBy("node").agg(F.sum("n").alias("neighbours")), "jaccard-neighbours")
    # most neighbours first, then the greatest node
    lead = members.join(central, "node").groupBy("shingle").agg(F.max(F.struct("neighbours", "node", "size", "place")).alias("x"))
    lead = written(lead.select("shingle", F.col("x.node").alias("leader"), F.col("x.size").alias("leader_size"), F.col("x.place").alias("leader_place")), "jaccard-leaders")
    pairs = members.join(lead, "shingle").where("node <> leader").where(_may_link("size", "leader_size", "place", "leader_place"))
    pairs = written(pairs.select("leader", "node", "size").distinct(), "jaccard-leader-pairs")
    weight = pairs.groupBy("leader").agg(F.ceil(F.sum("size") / VERIFY_SHINGLES).cast("int").alias("parts"))
    weight = written(weight, "jaccard-leader-parts")
    left = weight.select(F.col("leader").alias("place"), F.lit(0).alias("left_part"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("right_part"), F.col("leader").alias("node"), F.col("leader").alias("label"))
    right = pairs.join(weight, "leader").select(F.col("leader").alias("place"), F.lit(0).alias("left_part"), F.pmod(F.hash("node"), F.col("parts")).alias("right_part"), "node", F.col("node").alias("label"))
    return left, right


def _may_link(size: str, other: str, place: str, other_place: str):
    """The length filter, and the positional one: what can be shared before and after this shingle."""
    return F.expr(
        f"100 * least({size}, {other}) >= {PERCENT} * greatest({size}, {other}) and "
        f"{100 + PERCENT} * (least({place}, {other_place}) + least({size} - {place}, {other} - {other_place})) >= {PERCENT} * ({size} + {other})"
    )


def _candidate_stars(labelled: DataFrame, profiles: DataFrame) -> DataFrame:
    """(a, b): edges that join all nodes with a pair of different classes that passes the filters in a bucket."""
    parts = labelled.groupBy("shingle", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = parts.groupBy("shingle").agg(F.max(F.struct("n", "label")).alias("most"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("labels")).where("labels > 1")
    mixed = mixed.select(
        "shingle",
        F.col("most.label").alias("main"),
        F.ceil((F.col("all") - F.col("most.n")) / FILTER_BLOCK).cast("int").alias("left_parts"),
        F.ceil(F.col("all") / FILTER_BLOCK).cast("int").alias("right_parts"),
    )
    here = labelled.join(written(mixed, "jaccard-mixed"), "shingle")
    here = written(here.join(profiles.select("node", "cells"), "node"), "jaccard-mixed-members")
    columns = ["shingle", "left_part", "right_part", "node", "label", "size", "place", "cells"]
    left = here.where("label <> main").withColumn("left_part", F.pmod(F.hash("node"), F.col("left_parts"))).withColumn("right_part", F.explode(F.sequence(F.lit(0), F.col("right_parts") - 1)))
    right = here.withColumn("right_part", F.pmod(F.hash("node"), F.col("right_parts"))).withColumn("left_part", F.explode(F.sequence(F.lit(0), F.col("left_parts") - 1)))
    # toDF renews the columns: both sides come from the same table
    sides = [side.select(*columns).toDF(*columns).groupBy(*columns[:3]) for side in (left, right)]
    return sides[0].cogroup(sides[1]).applyInArrow(_stars, "a binary, b binary")


def _group_sides(groups: DataFrame, labelled: DataFrame, profiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes of candidate groups on both sides of blocks of bounded content."""
    labels = labelled.select("node", "label", "size").distinct()
    own = written(groups.select("node", F.col("label").alias("place")).join(labels, "node"), "jaccard-group-members")
    parts = own.groupBy("place").agg(F.ceil(F.sum("size") / VERIFY_SHINGLES).cast("int").alias("parts"))
    own = own.join(written(parts, "jaccard-group-parts"), "place").withColumn("part", F.pmod(F.hash("node"), F.col("parts")))
    # of two parts the lower is on the left
    left = own.select("place", F.col("part").alias("left_part"), F.explode(F.sequence(F.col("part"), F.col("parts") - 1)).alias("right_part"), "node", "label")
    right = own.select("place", F.explode(F.sequence(F.lit(0), F.col("part"))).alias("left_part"), F.col("part").alias("right_part"), "node", "label")
    return left, right


def _verified(sides: tuple[DataFrame, DataFrame], profiles: DataFrame, by_label: bool = False) -> DataFrame:
    """(a, b) of linked nodes with different labels on the two sides of a block, or of their labels."""
    keys = ["place", "left_part", "right_part"]
    columns = [*keys, "node", "label", "size", "shingles", "cells"]
    blocks = [side.join(profiles, "node").select(*columns).toDF(*columns).groupBy(*keys) for side in sides]
    ends = "label" if by_label else "node"

    def links(left: pa.Table, right: pa.Table) -> pa.Table:
        return _links(left, right, ends)

    return blocks[0].cogroup(blocks[1]).applyInArrow(links, "a binary, b binary")


def _pairs(rows: list[tuple[bytes, bytes]]) -> pa.Table:
    return pa.table({"a": pa.array([min(p) for p in rows], pa.binary()), "b": pa.array([max(p) for p in rows], pa.binary())})


class _Side:
    """One side of a block, as arrays."""

    def __init__(self, rows: pa.Table) -> None:
        self.node, self.label = rows.column("node").to_pylist(), rows.column("label").to_pylist()
        self.size = rows.column("size").to_numpy()
        self.cells = np.frombuffer(b"".join(rows.column("cells").to_pylist()), dtype=np.uint8).reshape(-1, CELLS).astype(np.int16)

    def near(self, size: int, cells: np.ndarray) -> np.ndarray:
        """The length filter, and the suffix filter: sets that differ in more cells than linked ones can."""
        total = self.size + size
        fits = 100 * np.minimum(self.size, size) >= PERCENT * np.maximum(self.size, size)
        rows = np.flatnonzero(fits)
        # counts are kept modulo 256, so a difference is the shorter way round
        apart = np.abs(self.cells[rows] - cells)
        apart = np.minimum(apart, 256 - apart).sum(axis=1, dtype=np.int64)
        return rows[(100 + PERCENT) * apart <= (100 - PERCENT) * total[rows]]


def _stars(left: pa.Table, right: pa.Table) -> pa.Table:
    """Edges from the first to the other ends of all pairs that pass the filters; a class counts as one node."""
    edges: list[tuple[bytes, bytes]] = []
    if not left.num_rows or not right.num_rows:
        return _pairs(edges)
    one, other = _Side(left), _Side(right)
    place, places = left.column("place").to_numpy(), right.column("place").to_numpy()
    name = {x: k for k, x in enumerate(dict.fromkeys(one.label + other.label))}
    label = np.array([name[x] for x in other.label])
    # nodes in one candidate group already need no further edge
    group = np.arange(len(other.node))
    for i, node in enumerate(one.node):
        near = other.near(one.size[i], one.cells[i])
        near = near[label[near] != name[one.label[i]]]
        shared = np.minimum(places[near], place[i]) + np.minimum(other.size[near] - places[near], one.size[i] - place[i])
        near = near[(100 + PERCENT) * shared >= PERCENT * (other.size[near] + one.size[i])]
        if len(near):
            found, first = np.unique(group[near], return_index=True)
            edges += [(node, other.node[j]) for j in near[first]]
            group[np.isin(group, found)] = found[0]
    return _pairs(list(dict.fromkeys((min(p), max(p)) for p in edges)))


def _links(left: pa.Table, right: pa.Table, ends: str) -> pa.Table:
    pairs: list[tuple[bytes, bytes]] = []
    if not left.num_rows or not right.num_rows:
        return _pairs(pairs)
    one, other = _Side(left), _Side(right)
    names = [t.column(ends).to_pylist() for t in (left, right)]
    shingles = [[np.frombuffer(x, dtype=np.uint64) for x in t.column("shingles").to_pylist()] for t in (left, right)]
    # a part of a group against itself has every pair twice
    same = ends == "label" and left.column("left_part")[0] == left.column("right_part")[0]
    joined: dict[bytes, bytes] = {}

    def root(label: bytes) -> bytes:
        while label in joined:
            label = joined[label]
        return label

    for i, own in enumerate(one.label):
        for j in other.near(one.size[i], one.cells[i]):
            if same and other.node[j] <= one.node[i]:
                continue
            a, b = root(own), root(other.label[j])
            if a != b and _similar(shingles[0][i], shingles[1][j]):
                joined[max(a, b)] = min(a, b)
                pairs.append((names[0][i], names[1][j]))
    return _pairs(pairs)


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    at = np.searchsorted(a, b)
    both = int((a[np.minimum(at, len(a) - 1)] == b).sum())
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one text after the other, and where each text's begin."""
    words = W.split(texts)
    words = W.Words(LOWER[words.data], words.starts, words.ends, words.first)
    h, counts = W.hashes(words), words.counts
    at = W.inside_text(words, SHINGLE)
    owner, values = words.text_of()[at], W.mix(W.windows(h, SHINGLE)[at])
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    whole = np.array([W.mix(W.windows(h[words.first[d] : words.first[d + 1]], int(counts[d])) + np.uint64(counts[d]))[0] for d in short], dtype=np.uint64)
    owner, values = np.concatenate([owner, short]), np.concatenate([values, whole])
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])
    owner, values = owner[new], values[new]
    return values, np.searchsorted(owner, np.arange(len(texts) + 1))


def _node_of(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _nodes_of(values: np.ndarray, first: np.ndarray) -> list[bytes]:
    return [_node_of(values[a:b]) for a, b in zip(first[:-1], first[1:])]


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.slices(batches, "text"):
        values, first = shingle_sets(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("text_key"), pa.array(_nodes_of(values, first), pa.binary()), pa.array(np.diff(first))],
            ["id", "text_key", "node", "size"],
        )


def _screen_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.slices(batches, "text"):
        values, first = shingle_sets(batch.column("text"))
        size = np.diff(first)
        taken = np.minimum(size, size - (PERCENT * size + 99) // 100 + 1 + SCREEN_MORE * size // 100)
        taken[size == 0] = 0
        keys = np.array([int.from_bytes(x[:8], "big", signed=True) for x in _nodes_of(values, first)], dtype=np.int64)
        shingles = values[W.ragged(first[:-1], taken)]
        yield pa.RecordBatch.from_arrays([pa.array(shingles.view(np.int64)), pa.array(np.repeat(keys, taken))], ["shingle", "key"])


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.slices(batches, "text"):
        values, first = shingle_sets(batch.column("text"))
        blobs = [values[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(np.diff(first)), pa.array(blobs, pa.binary())], ["node", "size", "shingles"])


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for d in range(batch.num_rows):
            values = np.frombuffer(batch.column("shingles")[d].as_py(), dtype=np.int64)
            n = len(values)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.repeat(batch.column("node")[d], n), pa.repeat(batch.column("size")[d], n)], ["shingle", "node", "size"])


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contents with the number of shingles in each cell, modulo 256."""
    for batch in batches:
        cells = [np.bincount(np.frombuffer(x, dtype=np.uint64) >> np.uint64(56), minlength=CELLS).astype(np.uint8).tobytes() for x in batch.column("shingles").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.binary())], ["node", "size", "shingles", "cells"])

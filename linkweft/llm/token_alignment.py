"""Alignment of the tokens of two tokenizers over the same texts.

1.  A text is tokenised as a whole by both; tokens have known bytes, so their ends follow
    from the sums of lengths, and the bytes themselves are compared with the text.
2.  Places where both have a token end cut a text into groups.
3.  All texts of a slice are aligned and their groups spelled in arrays, without a step per token.
4.  The last tokens of each group, before a place where both have an end, are linked.  Links are summed over all texts in Spark.
    One token of a linked pair ends with the other one's bytes, so the vocabularies bound
    the number of distinct pairs (`most_pairs`), and the sums can be handed to every task.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweft.llm import words as W
from linkweft.llm.frames import without, written

# Bytes of text aligned at once; words, and their characters, after which a worker drops the less used half of them.
SLICE_BYTES = 1 << 18
KEPT_WORDS = 200_000
KEPT_CHARS = 4_000_000

# The space mark of word pieces, and the words that byte-level BPE splits a text into (fixed values).
SPACE_MARK = "▁"
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Words end before a single space that stands between another character and a visible one.
SPLIT = re.compile(r"(?<=[^ ]) (?=\S)")
OTHER_SPACES = re.compile(r"\A | (?:\s|\Z)")

# What comes after an id in the text of the groups.
AFTER = (",", "|", ";", "")

OUTPUTS = ("n_a", "n_b", "n_groups", "groups", "links")
NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


class Vocabulary:
    """Bytes of all tokens, one after the other, with their lengths."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.tokens = tokens
        self.data = pa.array(tokens, pa.large_binary())
        self.length = np.array([len(t) for t in tokens], dtype=np.int64)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        joined = self.data.take(pa.array(ids, pa.int64())).buffers()[2]
        return np.frombuffer(joined, dtype=np.uint8)[: self.length[ids].sum()] if joined else np.zeros(0, dtype=np.uint8)


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves, the rest from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class ByteLevel:
    """A byte-level BPE file; special token strings in a text are text.

    If its merges are in the order of their ids, ids alone rank the merges, and tiktoken gives
    the same tokens in a sixth of the time; other files are left to `tokenizers`.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        model, letters = parts["model"], _byte_letters()
        spelled = {name: bytes(letters[c] for c in name) for name in model["vocab"] if all(c in letters for c in name)}
        tokens = [b""] * (1 + max([*model["vocab"].values(), *(t["id"] for t in parts["added_tokens"])]))
        for token in parts["added_tokens"]:
            tokens[token["id"]] = token["content"].encode()
        for name, k in model["vocab"].items():
            tokens[k] = spelled.get(name, name.encode())
        self.vocabulary = Vocabulary(tokens)
        self.ranked = self.tokenizer = None
        if _ranked_by_id(parts):
            from tiktoken import Encoding

            ranks = {spelled[name]: k for name, k in model["vocab"].items() if name in spelled}
            self.ranked = Encoding("byte level", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(path)
            self.tokenizer.encode_special_tokens = True

    @property
    def by_word(self) -> bool:
        """Whether the words of a text (`split_words`) have the tokens that they have alone: `WORDS` sees to it."""
        return self.ranked is not None

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.ranked:
            return [self.ranked.encode_ordinary(" " + t) for t in texts]
        return [e.ids for e in self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


def _ranked_by_id(parts: dict) -> bool:
    """Whether a tokenizer file is plain byte-level BPE with ids that grow with its merges."""
    model, split = parts["model"], parts["pre_tokenizer"] or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    if not plain or parts["normalizer"] or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        return False
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    ids = [model["vocab"][left + right] for left, right in merges]
    inner = len(model["vocab"]) - sum(t["content"] in model["vocab"] for t in parts["added_tokens"])
    return ids == sorted(set(ids)) and len(ids) + 256 == inner and min(ids, default=256) >= 256


class WordPieces:
    """A sentencepiece model with byte fallback, which puts a space before a text itself."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        self.vocabulary = Vocabulary([self._bytes(k) for k in range(size)])

    def _bytes(self, k: int) -> bytes:
        piece = self.model.id_to_piece(k)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(k) else piece.replace(SPACE_MARK, " ").encode()

    @property
    def by_word(self) -> bool:
        """Whether the words of a text (`split_words`) have the tokens that they have alone.

        Pairs are merged to pieces of the file only; so no merge goes over the begin of a word if
        no piece has a space mark after another character, and characters are left as they are.
        """
        from sentencepiece import sentencepiece_model_pb2

        file = sentencepiece_model_pb2.ModelProto.FromString(self.model.serialized_model_proto())
        rules, trainer = file.normalizer_spec, file.trainer_spec
        plain = not rules.precompiled_charsmap and not rules.remove_extra_whitespaces and rules.add_dummy_prefix and rules.escape_whitespaces
        merges = trainer.model_type == trainer.BPE and not trainer.treat_whitespace_as_suffix
        return plain and merges and not any(SPACE_MARK in p.piece.lstrip(SPACE_MARK) for p in file.pieces)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def split_words(text: str) -> list[str]:
    """The words of a text; each had a space before it, the first the one that the tokenizers put there.

    Longer runs of white space are inside words, for there tokens depend on both sides.
    """
    return SPLIT.split(text) if OTHER_SPACES.search(text) else text.split(" ")


class Aligner:
    """Both tokenizers of a worker, and the words it has met."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.a, self.b = ByteLevel(a_path), WordPieces(b_path)
        most = max(len(self.a.vocabulary.tokens), len(self.b.vocabulary.tokens))
        self.names = pa.array([str(k) + after for k in range(most) for after in AFTER])
        self.by_word = self.a.by_word and self.b.by_word
        # words with their numbers; by number n_a, n_b, n_groups, groups and uses; the links of all, one word after the other
        self.known: dict[str, int] = {}
        self.numbers = np.zeros((3, 0), dtype=np.int64)
        self.groups: list[str] = []
        self.uses = np.zeros(0, dtype=np.int64)
        self.links = np.zeros(0, dtype=np.int64)
        self.chars = 0

    def _links_of(self, word: np.ndarray) -> np.ndarray:
        n_links = self.numbers[2]
        return self.links[W.ragged((np.cumsum(n_links) - n_links)[word], n_links[word])]

    def _forget(self) -> None:
        kept = np.sort(np.argsort(-self.uses, kind="stable")[: len(self.uses) // 2])
        words = list(self.known)
        self.known = {words[k]: number for number, k in enumerate(kept.tolist())}
        self.links = self._links_of(kept)
        self.numbers, self.uses = self.numbers[:, kept], self.uses[kept] // 2
        self.groups = [self.groups[k] for k in kept.tolist()]
        self.chars = sum(map(len, self.known))

    def _learn(self, words: list[str]) -> None:
        *numbers, groups, links = self.whole(words)
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words)), strict=True))
        self.chars += sum(map(len, words))
        self.numbers = np.concatenate([self.numbers, numbers], axis=1)
        self.groups += groups
        self.uses = np.concatenate([self.uses, np.zeros(len(words), dtype=np.int64)])
        self.links = np.concatenate([self.links, links])

    def align(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str], np.ndarray]:
        """`whole` with words tokenised once and remembered; the operator tokenises whole texts and does not use it."""
        if not self.by_word:
            return self.whole(texts)
        if len(self.known) > KEPT_WORDS or self.chars > KEPT_CHARS:
            self._forget()
        words = list(map(split_words, texts))
        every = list(chain.from_iterable(words))
        new = [w for w in dict.fromkeys(every) if w not in self.known]
        if new:
            self._learn(new)
        word = np.fromiter(map(self.known.__getitem__, every), dtype=np.int64, count=len(every))
        self.uses += np.bincount(word, minlength=len(self.uses))
        size = np.array([len(w) for w in words], dtype=np.int64)
        ends = np.concatenate([[0], np.cumsum(size)])
        # a text has no tokens where one of its words has none
        none = np.diff(np.concatenate([[0], np.cumsum(self.numbers[0][word] == 0)])[ends]) > 0
        word, size = word[np.repeat(~none, size)], np.where(none, 0, size)
        ends = np.concatenate([[0], np.cumsum(size)])
        n_a, n_b, n_groups = [np.diff(np.concatenate([[0], np.cumsum(n[word])])[ends]) for n in self.numbers]
        spelled = list(map(self.groups.__getitem__, word.tolist()))
        groups = [";".join(spelled[a:b]) for a, b in zip(ends.tolist(), ends[1:].tolist(), strict=False)]
        return n_a, n_b, n_groups, groups, self._links_of(word)

    def whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str], np.ndarray]:
        """n_a, n_b, n_groups and groups of each text, and the codes of all links, one text after the other."""
        raw = [(" " + t).encode() for t in texts]
        ids = [_flat(side.encode(texts)) for side in (self.a, self.b)]
        same = np.array([bool(t) for t in texts])
        for side, (flat, ends) in zip((self.a, self.b), ids):
            spelled = side.vocabulary.bytes_of(flat).tobytes()
            at = np.concatenate([[0], np.cumsum(side.vocabulary.length[flat])])[ends].tolist()
            same &= [spelled[at[k] : at[k + 1]] == wanted for k, wanted in enumerate(raw)]
        (a, n_a), (b, n_b) = [_chosen(flat, ends, same) for flat, ends in ids]
        zeros = np.zeros(len(texts), dtype=np.int64)
        if not same.any():
            return zeros, zeros, zeros, [""] * len(texts), zeros[:0]

        # tokens that begin where one of the other side begins: places in both, over all texts
        a_from, b_from = [np.cumsum(side.vocabulary.length[x]) - side.vocabulary.length[x] for side, x in ((self.a, a), (self.b, b))]
        size = int(a_from[-1] + self.a.vocabulary.length[a[-1]])
        in_a, in_b = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
        in_a[a_from], in_b[b_from] = True, True
        at, bt = np.flatnonzero(in_b[a_from]), np.flatnonzero(in_a[b_from])
        last_a, last_b = [np.append(x[1:], n) - 1 for x, n in ((at, len(a)), (bt, len(b)))]
        links = a[last_a] * len(self.b.vocabulary.length) + b[last_b]

        # texts begin at such places, too
        begins = np.searchsorted(at, np.cumsum(n_a) - n_a)
        n_groups = np.diff(np.append(begins, len(at)))

        # the ids of each group, those of A first, each with what comes after it
        spelled = np.empty(len(a) + len(b), dtype=np.int64)
        names = [x * len(AFTER) for x in (a, b)]
        names[0][last_a] += AFTER.index("|")
        names[1][last_b] += AFTER.index(";")
        ends = np.cumsum(n_b)[same] - 1
        names[1][ends] = b[ends] * len(AFTER) + AFTER.index("")
        spelled[np.arange(len(a)) + np.repeat(bt, np.diff(np.append(at, len(a))))] = names[0]
        spelled[np.arange(len(b)) + np.repeat(last_a + 1, np.diff(np.append(bt, len(b))))] = names[1]
        of_text = pa.array(np.concatenate([[0], np.cumsum(n_a + n_b)]), pa.int32())
        groups = pc.binary_join(pa.ListArray.from_arrays(of_text, self.names.take(pa.array(spelled))), "")
        return n_a, n_b, n_groups, groups.to_pylist(), links


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids, one text after the other, and the ends between the texts."""
    ends = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)])
    return np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=int(ends[-1])), ends


def _chosen(flat: np.ndarray, ends: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the chosen texts, and the number of ids of every text: none of the others."""
    number = np.diff(ends)
    return flat[np.repeat(same, number)], np.where(same, number, 0)


def most_pairs(a: Vocabulary, b: Vocabulary) -> int:
    """A bound on the number of different linked pairs: one token's bytes end with the other's."""
    ends = 0
    for one, other in ((a, b), (b, a)):
        spelled: dict[bytes, int] = {}
        for token in other.tokens:
            spelled[token] = spelled.get(token, 0) + 1
        ends += sum(spelled.get(token[k:], 0) for token in one.tokens for k in range(len(token)))
    return ends


_loaded: dict[tuple[str, str], Aligner] = {}


def _aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _loaded:
        _loaded[a_path, b_path] = Aligner(a_path, b_path)
    return _loaded[a_path, b_path]


def aligned_batches(batches: Iterator[pa.RecordBatch], aligner: Aligner) -> Iterator[pa.RecordBatch]:
    """(row, text) with the text replaced by the outputs; every text is tokenised as a whole by both."""
    for batch in W.slices(batches, "text", SLICE_BYTES):
        n_a, n_b, n_groups, groups, links = aligner.whole([t or "" for t in batch.column("text").to_pylist()])
        ends = pa.array(np.concatenate([[0], np.cumsum(n_groups)]), pa.int32())
        columns = [pa.array(n_a), pa.array(n_b), pa.array(n_groups), pa.array(groups, pa.string()), pa.ListArray.from_arrays(ends, pa.array(links))]
        yield pa.RecordBatch.from_arrays([batch.column("row"), *columns], ["row", *OUTPUTS])


def align(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text") -> DataFrame:
    """`docs` with n_a, n_b, n_groups (long), groups (string) and links (array of long).

    Both tokenise the text with a space before it.  `groups` lists the ids between places
    where tokens of both end, as `a1,a2|b1;a3|b2,b3`; a link is the code a * size of B + b
    of the two tokens that end there.  Null and empty texts, and those whose token bytes
    are not the text's, have no tokens: zeros, an empty text and an empty list.  Repeated
    rows get equal results, an empty table an empty one; input columns named like an output
    are replaced.  A text is tokenised as a whole, however long.
    """
    kept = without(docs, [c for c in OUTPUTS if c != text_col])
    carried = kept.select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    schema = f"row {kept.schema.simpleString()}, n_a long, n_b long, n_groups long, groups string, links array<long>"

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return aligned_batches(batches, _aligner(a_path, b_path))

    return carried.mapInArrow(aligned, schema).select("row.*", *OUTPUTS)


def link_counts(linked: DataFrame, links: str = "links") -> DataFrame:
    """(code, count): how many links each pair of ids has in all rows."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, counts = np.unique(batch.column("links").flatten().to_numpy(), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(counts, pa.int64())], ["code", "count"])

    return linked.select(F.col(links).alias("links")).mapInArrow(counted, "code long, count long").groupBy("code").agg(F.sum("count").alias("count"))


def summary(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    n_best counts links whose pair has the most links of all pairs with its B id, ties
    included; count_sum adds up the counts of the links' pairs.  Rows are those of `align`;
    null ids stay null, and rows with the same id are rows of their own.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    aligned = align(rows, a_path, b_path).select("doc_id", "n_a", "n_b", "n_groups", digest.alias("groups_sha256"), "links")
    aligned = written(aligned, "aligned")
    counts = written(link_counts(aligned), "link-counts")

    pieces, spark = WordPieces(b_path).vocabulary, docs.sparkSession
    bound = most_pairs(ByteLevel(a_path).vocabulary, pieces)
    if counts.count() > bound:
        raise ValueError(f"more than the {bound} pairs that the vocabularies allow")
    sums = counts.toArrow()
    code, count = sums.column("code").to_numpy(), sums.column("count").to_numpy()
    order = np.argsort(code)
    code, count = code[order], count[order]
    most = np.zeros(len(pieces.tokens), dtype=np.int64)
    np.maximum.at(most, code % len(pieces.tokens), count)
    shared = spark.sparkContext.broadcast((code, count, count == most[code % len(pieces.tokens)]))

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, best = shared.value
        for batch in batches:
            links = batch.column("links")
            place = np.searchsorted(codes, links.flatten().to_numpy())
            # a list's sum is the difference of running sums at its ends
            ends = np.concatenate([[0], np.cumsum(np.diff(links.offsets.to_numpy()))])
            sums = [np.diff(np.concatenate([[0], np.cumsum(x[place].astype(np.int64))])[ends]) for x in (best, counts)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")], pa.array(np.diff(ends)), *map(pa.array, sums), batch.column("groups_sha256")],
                ["doc_id", *NUMBERS, "groups_sha256"],
            )

    kind = aligned.schema["doc_id"].dataType.simpleString()
    return aligned.mapInArrow(weighed, f"doc_id {kind}, {', '.join(f'{n} long' for n in NUMBERS)}, groups_sha256 string")

"""Similarity join, token alignment and phrases, against brute force."""

import hashlib
import json
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tokenizers

from linkweft.llm import jaccard_join, phrases, token_alignment
from linkweft.llm.fm_index import DEPTH, Index, packed, unpacked
from linkweft.llm.queries import QUERIES
from tests.llm.conftest import ROWS

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_of(texts):
    out = {}
    for i, text in texts.items():
        w = WORD.findall((text or "").translate(LOWER))
        out[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    return out


def components_of(texts):
    """(size of the set, component) by comparing all pairs that share a shingle."""
    sets, parent, holders = sets_of(texts), {i: i for i in texts}, defaultdict(list)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    for i, s in sets.items():
        for j, both in Counter(j for g in s for j in holders[g] if j > i).items():
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in texts}


def family(rng, words, n, edits):
    """Copies of one text with random words replaced."""
    out = []
    for _ in range(n):
        copy = list(words)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(len(copy))] = f"n{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def found_components(docs):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs).collect()}


def test_components_at_the_limit(workers, monkeypatch):
    rng = random.Random(4)
    texts = ["A b C", "a B c", "a b", "", None, " \t "]
    for n, edits in ((40, 1), (40, 3), (80, 4), (120, 9), (200, 12)):
        words = rng.choices([f"v{k}" for k in range(300)], k=n)
        texts += family(rng, words, 30, edits)
        # a chain in which neighbours are linked
        chain = list(words)
        for k in range(12):
            chain[k * n // 12] = f"c{k}"
            texts.append(" ".join(chain))
    rng.shuffle(texts)
    docs = workers.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = components_of(dict(enumerate(texts)))
    assert len({c for _, c in expected.values()}) > 40
    assert found_components(docs) == expected
    # small blocks: every leader and every group in several parts
    monkeypatch.setattr(jaccard_join, "FILTER_BLOCK", 4)
    monkeypatch.setattr(jaccard_join, "VERIFY_SHINGLES", 500)
    assert found_components(docs) == expected


def test_filters_lose_no_linked_pair():
    rng = np.random.default_rng(5)
    for size in (1, 5, 40, 3000):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64) * np.uint64(2))
        gone = max(0, len(a) - -(-80 * len(a) // 100))
        b = np.sort(a[rng.permutation(len(a))[gone:]])
        assert jaccard_join._similar(a, b) and 100 * len(b) >= 80 * len(a)
        rows = pa.table({"node": [b"x"], "size": [len(b)], "shingles": [b.tobytes()]})
        (made,) = jaccard_join._profiles(iter(rows.to_batches()))
        side = jaccard_join._Side(pa.table({"node": [b"b"], "label": [b"b"], "size": [len(b)], "cells": made.column("cells")}))
        cells = np.bincount(a >> np.uint64(56), minlength=256).astype(np.uint8).astype(np.int16)
        assert side.near(len(a), cells).tolist() == [0]


def test_components_of_odd_rows(odd_docs, no_docs):
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(odd_docs).collect()), key=str)
    by_row = components_of({k: t for k, (_, t, _) in enumerate(ROWS)})
    least = {}
    for k, (i, _, _) in enumerate(ROWS):
        if i is not None:
            least[by_row[k][1]] = min(i, least.get(by_row[k][1], i))
    assert found == sorted(((i, by_row[k][0], least.get(by_row[k][1])) for k, (i, _, _) in enumerate(ROWS)), key=str)
    assert jaccard_join.jaccard_components(no_docs).count() == 0
    # rows without id: each distinct text once, none of them paired with all others
    copies = odd_docs.limit(0).unionByName(odd_docs.sparkSession.createDataFrame([(None, "p q r s t u"), (None, "p q r s t u"), (7, "p q R s t u"), (None, "p q x")], "doc_id long, text string"), allowMissingColumns=True)
    assert sorted(((r.doc_id, r.component_id) for r in jaccard_join.jaccard_components(copies).collect()), key=str) == sorted([(None, 7), (None, 7), (7, 7), (None, None)], key=str)


@pytest.fixture(scope="module")
def vocabularies():
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def aligned_by_brute_force(texts, a, b):
    """Summary rows from the sets of byte offsets where tokens end."""
    rows, counts = [], Counter()
    for text in texts:
        ids = [a.encode([text or ""])[0], b.encode([text or ""])[0]]
        spelled = [[v.tokens[i] for i in x] for v, x in zip((a.vocabulary, b.vocabulary), ids)]
        if not text or any(b"".join(s) != (" " + text).encode() for s in spelled):
            rows.append((0, 0, [], ""))
            continue
        ends = [dict(zip(np.cumsum([len(t) for t in s]).tolist(), range(len(s)))) for s in spelled]
        groups, links, i, j = [], [], 0, 0
        for end in sorted(ends[0].keys() & ends[1].keys()):
            p, q = ends[0][end] + 1, ends[1][end] + 1
            groups.append(",".join(map(str, ids[0][i:p])) + "|" + ",".join(map(str, ids[1][j:q])))
            links.append((ids[0][p - 1], ids[1][q - 1]))
            i, j = p, q
        counts.update(links)
        rows.append((len(ids[0]), len(ids[1]), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return [(n, m, len(x), len(x), sum(counts[p] == most[p[1]] for p in x), sum(counts[p] for p in x), s) for n, m, x, s in rows]


def test_alignment_is_that_of_token_ends(workers, sf_dir, vocabularies):
    docs = workers.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    odd = [(-1, None), (-2, ""), (-3, "a ▁ b"), (-4, " \n\t x <|endoftext|> </s> <0x0A>"), (-5, "東京 is naïve 👍🏽 é"), (-6, "x"), (-6, "x"), (None, "y  z\r\n")]
    rows = [tuple(r) for r in docs] + odd
    a, b = token_alignment.ByteLevel(vocabularies[0]), token_alignment.WordPieces(vocabularies[1])
    expected = [(i, *x) for (i, _), x in zip(rows, aligned_by_brute_force([t for _, t in rows], a, b))]
    found = token_alignment.summary(workers.createDataFrame(rows, "doc_id long, text string").repartition(5), *vocabularies)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


def test_words_are_aligned_once_as_in_their_text(vocabularies, monkeypatch):
    aligner = token_alignment.Aligner(*vocabularies)
    rng = random.Random(5)
    parts = [" ", " ", " ", "  ", "\n", "\t", "\r", "\x1c", "\x85", "\u00a0", "\u3000", "\u200b", "a", "the", "word", "'s", "'", "é", "e\u0301", "12", "...", "東京", "👍🏽", "<s>", "Ａ"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(14))) for _ in range(3000)] + ["a ▁ b", " ▁", "", " ", "a the word"]
    expected, found = aligner.whole(texts), aligner.align(texts)
    assert all(list(x) == list(y) for x, y in zip(found, expected, strict=True))
    assert expected[0][-5] == expected[0][-4] == 0 < expected[0][-1]
    with monkeypatch.context() as patched:
        patched.setattr(aligner, "whole", None)
        assert list(aligner.align(["word the a", *texts])[4][-3:]) == list(expected[4][-3:])
    # with few words kept, results are the same
    monkeypatch.setattr(token_alignment, "KEPT_WORDS", 300)
    found = [aligner.align(texts[k : k + 100]) for k in range(0, len(texts), 100)]
    assert len(aligner.known) < 1000
    assert [g for x in found for g in x[3]] == expected[3] and np.concatenate([x[4] for x in found]).tolist() == expected[4].tolist()


def test_every_text_is_tokenised_as_a_whole(vocabularies, monkeypatch):
    texts = ["the word the word", "", None, "word  the", "the word the word", "x" * 70]
    aligner, seen = token_alignment.Aligner(*vocabularies), []
    for side in (aligner.a, aligner.b):
        monkeypatch.setattr(side, "encode", lambda given, encode=side.encode: seen.append(list(given)) or encode(given))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["row", "text"])
    for _ in range(2):
        rows = [r for b in token_alignment.aligned_batches(iter([batch]), aligner) for r in b.to_pylist()]
    assert seen == [[t or "" for t in texts]] * 4
    assert [r["row"] for r in rows] == list(range(len(texts)))
    expected = aligned_by_brute_force(texts, aligner.a, aligner.b)
    assert [(r["n_a"], r["n_b"], r["n_groups"]) for r in rows] == [tuple(x[:3]) for x in expected]


def test_byte_level_ids_are_those_of_the_file(vocabularies, sf_dir, spark):
    tokenizer = tokenizers.Tokenizer.from_file(vocabularies[0])
    tokenizer.encode_special_tokens = True
    texts = [r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    texts += ["", " ", "\x1c#" * 5000, "a" * 100_000, " " * 100_000, "\u3000 \u00a0x", "<|endoftext|>", "I'LL we'll '\u017f", "\U0001F468\u200d\U0001F469", "漢字" * 20_000, "1234567", "\r\n\t z"]
    side = token_alignment.ByteLevel(vocabularies[0])
    assert side.ranked and side.encode(texts) == [e.ids for e in tokenizer.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    assert all(side.vocabulary.tokens[k] == token_alignment.Vocabulary([side.vocabulary.tokens[k]]).bytes_of(np.array([0])).tobytes() for k in (0, 300, 50_256))


def test_other_byte_level_files_go_to_their_tokenizer(vocabularies, tmp_path):
    with open(vocabularies[0], encoding="utf-8") as file:
        parts = json.load(file)
    merges = parts["model"]["merges"]
    parts["model"]["merges"] = [*merges[1000:], *merges[:1000]]
    with open(tmp_path / "other.json", "w", encoding="utf-8") as file:
        json.dump(parts, file)
    other = token_alignment.ByteLevel(str(tmp_path / "other.json"))
    assert other.ranked is None and b"".join(other.vocabulary.tokens[k] for k in other.encode(["so it is"])[0]) == b" so it is"


def test_alignment_keeps_rows(odd_docs, no_docs, vocabularies):
    found = token_alignment.align(odd_docs, *vocabularies)
    assert found.columns == [*odd_docs.columns, "n_a", "n_b", "n_groups", "groups", "links"]
    rows = found.collect()
    assert len(rows) == len(ROWS)
    assert all((r.n_a > 0) == bool(r.text) and len(r.links) == r.n_groups == len(r.groups.split(";")) * (r.n_a > 0) for r in rows)
    assert token_alignment.summary(no_docs, *vocabularies).count() == 0


def test_linked_tokens_end_alike(vocabularies):
    a, b = token_alignment.ByteLevel(vocabularies[0]).vocabulary, token_alignment.WordPieces(vocabularies[1]).vocabulary
    assert len(a.tokens) == 50_257 and len(b.tokens) == 32_000
    small = token_alignment.Vocabulary([b"ab", b"b", b"c"]), token_alignment.Vocabulary([b"b", b"xc", b"c", b"ab"])
    pairs = [(x, y) for x in small[0].tokens for y in small[1].tokens if x.endswith(y) or y.endswith(x)]
    assert token_alignment.most_pairs(*small) >= len(pairs)


def test_index_counts_all_patterns():
    rng = random.Random(2)
    text = [0]
    for _ in range(40):
        text += [rng.randrange(1, 5) for _ in range(rng.randrange(1, 12))] + [0]
    index = Index.of(np.array(text, dtype=np.int32), 4)
    expected = [Counter(tuple(text[i : i + k]) for i in range(len(text) - k + 1) if 0 not in text[i : i + k]) for k in range(1, DEPTH + 1)]
    for turns in ((index.left,) * 3, (index.right,) * 3, (index.left, index.right, index.left), (index.right, index.right, index.left)):
        grams = index.words()
        for k in range(DEPTH):
            assert dict(zip(map(tuple, grams.symbols.tolist()), grams.size.tolist())) == expected[k]
            grams = turns[k](grams) if k < 3 else grams
    assert unpacked(packed(np.array(text))).tolist() == text


def phrases_of(rows, least, per_lang):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            counts[lang].update(tuple(w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        often = {g: n for g, n in f.items() if len(g) > 1 and n >= least}
        around = Counter()
        for g, n in often.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    around[g[i : i + k]] = max(around[g[i : i + k]], n)
        found = []
        for g, a in often.items():
            if not around[g] or 100 * around[g] < 80 * a:
                score, _, left, right = min((2_000_000 * a // (f[g[:k]] + f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
                found.append((-score, -a, " ".join(g).encode(), left, right))
        out += [(lang, n, g.decode(), -a, left, right, total[lang], -score) for n, (score, a, g, left, right) in enumerate(sorted(found)[:per_lang], 1)]
    return sorted(out)


def test_phrases_are_those_of_all_ngrams(workers):
    rng = random.Random(7)
    vocabulary = [*"abcdef", "É", "é", "Ab", "a\x00", "東京", "x-y"]
    rows = []
    for k in range(200):
        words = rng.choices(vocabulary, weights=range(len(vocabulary), 0, -1), k=rng.randrange(60))
        rows.append((rng.choice(["en", "de", None, ""]), "".join(w + rng.choice([" ", " ", "\t", "  ", ", ", ".\n", "\x0b", " "]) for w in words)))
    rows += [("en", None), ("en", ""), (None, " . ,, \n"), ("fr", "one two"), ("en", " ".join(["over and over"] * 3000))]
    docs = workers.createDataFrame([(x, t, "clash", 1) for x, t in rows], "lang string, text string, phrase string, n int").repartition(3)
    for limit in (50, 400, 2_000_000):
        found = phrases.collocations(docs, least=5, per_lang=40, shard_words=limit)
        assert sorted(map(tuple, found.collect())) == phrases_of(rows, 5, 40)


def test_phrase_scores_pass_64_bits(workers):
    big = 4 * 10**13
    row = workers.createDataFrame([(big, big, big + 1)], "a long, l long, r long")
    score = phrases._score(*[row[c] for c in ("a", "l", "r")])
    assert row.select(score).first()[0] == 2_000_000 * big // (2 * big + 1)


def test_phrases_of_no_rows(odd_docs, no_docs):
    assert phrases.collocations(no_docs).count() == 0
    assert phrases.collocations(odd_docs.where("text is null")).count() == 0


def test_phrases_of_given_table(spark, sf_dir):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text").collect()]
    assert sorted(map(tuple, QUERIES["op13_phrase_collocations"](spark, sf_dir).collect())) == phrases_of(rows, 30, 2000)

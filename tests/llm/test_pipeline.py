"""Every stage of the pipeline, and its run, against plain Python on a planted fixture."""

import random
import re
import zlib
from array import array
from collections import Counter

import pytest

import corpus_pipeline
from linkweft.llm import quality_nbsvm
from linkweft.llm.frames import written
from tests.llm.test_duplicates import WORD, classes_of, least_edits
from tests.llm.test_formats import VOCABULARY, places_are_gapless, tokenizers

# The characters that end a word of a benchmark item (fixed values).
NO_WORD = re.compile("[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f -⁯]+")


@pytest.fixture(scope="module")
def planted_dir(workers, sf_dir, tmp_path_factory):
    """The given documents and labels, with copies, edited copies, passages and benchmark items put in."""
    spark, folder, rng = workers, str(tmp_path_factory.mktemp("planted")), random.Random(12)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    rows = docs.orderBy("doc_id").collect()
    clean = [r for r in rows if r.doc_id in good and r.text and 80 < len(r.text.split()) < 400][:12]
    items = [" ".join(r.text.split()[5:35]) for r in rows if r.doc_id not in good and r.text and len(r.text.split()) > 60][:3]
    passage = clean[0].text.split()[:60]
    last, more = max(r.doc_id for r in rows), []

    def put(words, like, text=None):
        text = " ".join(words) if text is None else text
        more.append((last + 1 + len(more), text, like.lang, like.source, len(text)))

    for r in clean[:4]:
        put([], r, r.text)
        words = r.text.split()
        words[len(words) // 2] = "other"
        put(words, r)
    for r in clean[4:8]:
        words = r.text.split()
        put(words[: len(words) // 3] + passage + rng.sample(words, len(words)), r)
    for r, item in zip(clean[8:], items):
        words, held = rng.sample(r.text.split(), 80), item.split()
        held[7], held[20] = "changed", "twice"
        put(words[:40] + held + words[40:], r)
    put([], clean[0], "")
    planted = docs.unionByName(spark.createDataFrame(more, docs.schema))
    planted.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def without_repeats(texts, size=50):
    words = {i: WORD.findall(t or "") for i, t in texts.items()}
    first, out = {}, {}
    for i in sorted(words):
        for k in range(len(words[i]) - size + 1):
            first.setdefault(tuple(words[i][k : k + size]), i)
    for i, w in words.items():
        gone = {p for k in range(len(w) - size + 1) if first[tuple(w[k : k + size])] < i for p in range(k, k + size)}
        out[i] = " ".join(x for p, x in enumerate(w) if p not in gone) if gone else texts[i]
    return out


def holds(text, items):
    words = [w for w in NO_WORD.split((text or "").lower()) if w]
    return any(least_edits(x, words) <= len(x) // 5 for x in items)


def pieces_of(texts, capacity=2048):
    encode = tokenizers.Tokenizer.from_file(VOCABULARY)
    out = Counter()
    for i, text in texts.items():
        ids = [*encode.encode(text or "", add_special_tokens=False).ids, 0]
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = array("I", ids[at : at + capacity])
            out[i, n, at, len(part), zlib.crc32(part.tobytes())] += 1
    return out


def found_pieces(packed):
    return Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed)


def test_stages_and_run_by_brute_force(workers, planted_dir):
    stages = dict(corpus_pipeline.STAGES)
    docs = workers.read.parquet(f"{planted_dir}/documents.parquet")
    benchmark = workers.read.parquet(f"{planted_dir}/benchmark.parquet").collect()
    items = [[w for w in NO_WORD.split(r.text.lower()) if w] for r in benchmark]
    columns = docs.columns
    kept = {r.doc_id: r.text for r in docs.collect()}
    gone = {}

    def after(name):
        nonlocal docs, kept
        docs = written(stages[name](workers, docs, planted_dir), name)
        rows = docs.collect()
        assert docs.columns == columns and all(r.n_chars == len(r.text or "") for r in rows)
        found = {r.doc_id: r.text for r in rows}
        assert len(found) == len(rows)
        gone[name] = len(kept) - len(found)
        kept = found
        return found

    model = quality_nbsvm.fit(docs, workers.read.parquet(f"{planted_dir}/labels.parquet"))
    scores = {r.doc_id: r.score for r in quality_nbsvm.score(docs, model, out="score").collect()}
    expected = {i: t for i, t in kept.items() if scores[i] >= corpus_pipeline.LEAST_QUALITY}
    assert after("quality_classifier") == expected

    classes = classes_of(kept)
    expected = {i: t for i, t in kept.items() if classes[i] == i}
    assert after("near_dedup") == expected

    expected = without_repeats(kept)
    assert any(expected[i] != kept[i] for i in kept)
    assert after("substring_dedup") == expected

    expected = {i: t for i, t in kept.items() if not holds(t, items)}
    assert after("decontamination") == expected
    assert all(gone[n] for n in ("quality_classifier", "near_dedup", "decontamination")) and not gone["substring_dedup"]

    expected = pieces_of(kept)
    packed = stages["best_fit_packing"](workers, docs, planted_dir).collect()
    assert found_pieces(packed) == expected
    places_are_gapless(packed, 2048)
    ran = corpus_pipeline.run(workers, planted_dir).collect()
    assert found_pieces(ran) == expected
    places_are_gapless(ran, 2048)
    assert len({r.sequence_id for r in ran}) == len({r.sequence_id for r in packed})

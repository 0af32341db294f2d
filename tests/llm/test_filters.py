"""Classifiers and rules: odd rows, held-out accuracy, statistics by brute force."""

import re
from collections import Counter

import pytest

from linkweft.llm import quality_nbsvm, quality_rules, queries, toxicity
from tests.llm.conftest import ROWS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tiny_labels(spark, target):
    rows = [(k, k % 2) for k in range(1, 11)] + [(None, 1), (3, None)]
    return spark.createDataFrame(rows, f"doc_id long, {target} int")


@pytest.mark.parametrize("module", [quality_nbsvm, toxicity])
def test_scores_of_odd_rows(workers, odd_docs, no_docs, no_labels, module):
    target = "toxic" if module is toxicity else "quality"
    for labels in (no_labels, tiny_labels(workers, target)):
        model = module.fit(odd_docs, labels, target)
        scored = module.score(odd_docs, model)
        assert scored.columns == ["doc_id", "text", "lang", "n_words", "row", "score"]
        found = scored.collect()
        assert len(found) == len(ROWS)
        assert all(0 <= r.score <= 1 for r in found)
        assert len({r.score for r in found if not r.text}) == 1
        assert module.score(no_docs, model).count() == 0


def test_rules_on_odd_rows(workers, odd_docs, no_docs, no_labels):
    model = quality_rules.fit(odd_docs, no_labels)
    assert quality_rules.apply_rules(no_docs, model).count() == 0
    found = quality_rules.apply_rules(odd_docs, model).collect()
    assert len(found) == len(ROWS)
    for r in found:
        text = r.text or ""
        words = WORD.findall(text)
        assert (r.n_words, r.word_chars) == (len(words), sum(map(len, words)))
        assert not (r.base_failed and r.kept)


def statistics_of(text):
    words = WORD.findall(text)
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    grams = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    covered = {k + j for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated, len(covered)


def test_rule_statistics_by_brute_force(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = queries.QUERIES["op9_quality_rules"](spark, sf_dir).collect()
    assert {r.doc_id for r in found} == set(texts)
    for r in found:
        expected = statistics_of(texts[r.doc_id])
        assert tuple(r[c] for c in quality_rules.COUNTS) == expected
        assert r.base_failed == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])


@pytest.mark.parametrize("name, target, least", [("op1_quality_nbsvm", "quality", 0.9), ("op8_toxicity_trees", "toxic", 0.85)])
def test_held_out_accuracy(spark, name, target, least):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r[target] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    found = [r for r in queries.QUERIES[name](spark, sf_dir).collect()]
    held = [r for r in found if r.held_out and r.doc_id in labels]
    assert len(found) == 1000 and held
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= least * len(held)


def test_line_and_word_statistics_of_small_texts():
    import pyarrow as pa

    texts = ["", None, "a\na\n\na", "\n\n", "a b c a b c", "x y\nx y \nx y", "a#b $ <>", "é é é é", "\na\n", "a\r\na\r\n"]
    found = quality_rules.statistics(pa.array(texts))
    for k, text in enumerate(texts):
        assert tuple(int(found[c][k]) for c in quality_rules.COUNTS) == statistics_of(text or ""), text

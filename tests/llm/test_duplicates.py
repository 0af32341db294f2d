"""Near duplicates, repeated passages and benchmark items, against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from linkweft.llm import decontaminate, near_dedup, queries
from linkweft.llm.components import components
from linkweft.llm.substring import remove_repeats
from tests.llm.conftest import PASSAGE, ROWS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts_of(spark, sf_dir):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


def classes_of(texts):
    """Class of each id by comparing all pairs that share a shingle."""
    sets = {}
    for i, t in texts.items():
        w = WORD.findall(t or "")
        sets[i] = Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()
    parent = {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def join(x, y):
        a, b = sorted((root(x), root(y)))
        parent[b] = a

    holders = defaultdict(list)
    for i in sorted(sets):
        for s in sets[i]:
            holders[s].append(i)
    shared = Counter((x, y) for v in holders.values() for n, y in enumerate(v) for x in v[:n])
    for (x, y), k in shared.items():
        a, b = sets[x], sets[y]
        both = sum(min(a[s], b[s]) for s in a.keys() & b.keys())
        if k >= 0.8 * (len(a) + len(b) - k) or both >= 0.8 * (sum(a.values()) + sum(b.values()) - both):
            join(x, y)
    empty = [i for i in sets if not sets[i]]
    for i in empty:
        join(empty[0], i)
    return {i: root(i) for i in texts}


def test_classes_are_those_of_all_pairs(spark, sf_dir):
    texts = texts_of(spark, sf_dir)
    found = {r.doc_id: r.class_id for r in queries.QUERIES["op5_dart_minhash"](spark, sf_dir).collect()}
    assert found == classes_of(texts)


def test_classes_in_a_large_group_of_near_copies(workers):
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(300):
        words = list(base)
        for _ in range(rng.randrange(8)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
        rows.append((1000 - i, " ".join(words)))
    rows += [(k, " ".join(f"c{k}_{j}" for j in range(40))) for k in range(50)]
    found = near_dedup.near_duplicates(workers.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.class_id for r in found.collect()} == classes_of(dict(rows))


def test_blocks_join_what_leaders_do_not(workers, monkeypatch):
    monkeypatch.setattr(near_dedup, "LEFT_BLOCK", 3)
    monkeypatch.setattr(near_dedup, "RIGHT_BLOCK", 5)
    rng = random.Random(9)
    base, rows = [f"w{j}" for j in range(100)], []
    for i in range(120):
        words = list(base)
        for _ in range(rng.randrange(14)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    found = near_dedup.near_duplicates(workers.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.class_id for r in found.collect()} == classes_of(dict(rows))


def test_copies_with_repeated_passages_are_alike_as_sets(workers):
    rng = random.Random(11)
    rows = []
    for k in range(40):
        words = [f"t{k}_{rng.randrange(10**6)}" for _ in range(200)]
        longer = words + words[-50:] * rng.randrange(4, 8)
        changed = list(longer)
        changed[rng.randrange(50)] = "new"
        rows += [(10 * k, " ".join(words)), (10 * k + 1, " ".join(longer)), (10 * k + 2, " ".join(changed)), (10 * k + 3, " ".join(words + words[-50:]))]
    # equal sets: near the first of them by counts alone, far from the second
    part = [[f"e{j}_{k}" for k in range(n)] for j, n in ((0, 100), (1, 30))]
    rows += [(1000, " ".join(part[0] + part[1] * 9 + part[0])), (1001, " ".join(part[0] * 9 + part[1] + part[0])), (1002, " ".join(part[0] * 9 + [f"z{k}" for k in range(40)]))]
    found = near_dedup.near_duplicates(workers.createDataFrame(rows, "doc_id long, text string"))
    classes = {r.doc_id: r.class_id for r in found.collect()}
    assert classes == classes_of(dict(rows))
    assert all(classes[10 * k + j] == 10 * k for k in range(40) for j in range(4))


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    found = near_dedup.near_duplicates(odd_docs).collect()
    assert len(found) == len(ROWS)
    by_id = {r.doc_id: r.class_id for r in found if r.doc_id is not None}
    assert by_id == {1: 1, 2: 2, 3: 2, 4: 2, 5: 5, 6: 6, 7: 6, 8: 5, 9: 9, 10: 10}
    assert sorted((r.class_id for r in found if r.doc_id is None), key=str) == [2, None]
    assert near_dedup.near_duplicates(no_docs).count() == 0
    kept = near_dedup.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 10, 2, 5, 6, 9, None, None]


def test_kept_rows_are_those_that_name_their_class(workers):
    a, b = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(30))
    rows = [(1, a, "x", 0), (5, b, "x", 1), (5, a, "x", 2), (9, b, "x", 3), (5, b, "x", 1)]
    docs = workers.createDataFrame(rows, "doc_id long, text string, row string, _copy_no int")
    assert sorted(map(tuple, near_dedup.keep_one(docs).collect())) == [(1, a, "x", 0), (5, b, "x", 1)]


def test_sketches_do_not_depend_on_the_steps(monkeypatch):
    rng = random.Random(5)
    texts = [None, "", "x", *(" ".join(rng.choices("abcdefgh", k=rng.randrange(60))) for _ in range(40))]
    rows = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(range(len(texts))), pa.array(texts)], ["id", "copy", "text"])
    whole = pa.Table.from_batches(near_dedup._sketches(iter([rows]))).to_pylist()
    monkeypatch.setattr(near_dedup, "STEP_TEXTS", 3)
    steps = pa.Table.from_batches(near_dedup._sketches(iter([rows]))).to_pylist()
    assert steps == whole and len(whole) == len(texts)


def test_signatures_estimate_weighted_similarity():
    rng = random.Random(2)
    a = [f"w{k}" for k in range(300)]
    b = list(a)
    for _ in range(15):
        b[rng.randrange(300)] = "z" + str(rng.random())
    texts = [" ".join(a), " ".join(b), " ".join(a + a[:150])]
    owner, values, counts = near_dedup.shingles(pa.array(texts))
    who, units, _ = near_dedup._units(owner, values, counts)
    made = near_dedup.signatures(who, units, 3, 2000)
    sets = [Counter(dict(zip(values[owner == k].tolist(), counts[owner == k].tolist()))) for k in range(3)]
    for x, y in ((0, 1), (0, 2), (1, 2)):
        both = sum((sets[x] & sets[y]).values())
        true = both / (sum(sets[x].values()) + sum(sets[y].values()) - both)
        assert abs((made[x] == made[y]).mean() - true) < 0.05
    assert len(np.unique(made[0])) == 2000


def test_components_of_paths_and_stars(workers):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 100 + k) for k in range(1, 60)] + [(300, 301), (301, 300), (302, 302)]
    rng.shuffle(edges)
    found = components(workers.createDataFrame(edges, "a long, b long")).collect()
    labels = {r.node: r.label for r in found}
    assert len(found) == len(labels)
    assert components(workers.createDataFrame([(1, 1)], "a long, b long")).count() == 0
    assert labels == {k: 0 for k in range(41)} | {100 + k: 100 for k in range(60)} | {300: 300, 301: 300}


def cut_by_brute_force(texts, size=50):
    words = {i: WORD.findall(t or "") for i, t in texts.items()}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - size + 1):
            first.setdefault(tuple(words[i][k : k + size]), i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < i:
                gone[k : k + size] = [True] * size
        kept = [x for x, g in zip(w, gone) if not g]
        out[i] = (len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def test_repeats_are_those_of_all_windows(spark, sf_dir):
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.QUERIES["op7_substring_dedup"](spark, sf_dir).collect()}
    assert found == cut_by_brute_force(texts_of(spark, sf_dir))


def test_repeats_with_small_windows(workers):
    rng = random.Random(3)
    texts = {i: " ".join(rng.choices("abc", k=rng.randrange(30))) for i in range(60)}
    docs = workers.createDataFrame(list(texts.items()), "doc_id long, text string")
    for size in (3, 5, 8):
        found = {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in remove_repeats(docs, size=size).collect()}
        assert found == cut_by_brute_force(texts, size)


def test_repeats_of_odd_rows(odd_docs, no_docs):
    cut = remove_repeats(odd_docs)
    assert cut.columns == ["doc_id", "text", "lang", "Score", "row", "n_words", "n_removed", "kept_text"]
    found = cut.collect()
    assert len(found) == len(ROWS)
    removed = sorted(((r.doc_id, r.n_removed) for r in found), key=str)
    assert removed == sorted([(1, 0), (10, 0), (2, 0), (3, 0), (4, 0), (5, 0), (6, 0), (7, 60), (8, 30_000), (8, 30_000), (9, 0), (None, 0), (None, 0)], key=str)
    assert next(r.kept_text for r in found if r.doc_id == 7) == "elsewhere and on"
    assert remove_repeats(no_docs).count() == 0


def least_edits(item, words):
    row = [0] * (len(words) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(words, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_leaks_at_the_edit_limit(workers):
    rng = random.Random(6)
    vocabulary = [f"v{k}" for k in range(400)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randrange(8, 60)))) for k in range(40)]
    docs, expected = [], set()
    for doc_id in range(160):
        item_id, text = items[doc_id % 40]
        words = text.split()
        for _ in range(rng.randrange(2 + len(words) // 4)):
            p = rng.randrange(len(words))
            words[p : p + rng.randrange(2)] = rng.choices(vocabulary, k=rng.randrange(2))
            words = words or ["v0"]
        words = rng.choices(vocabulary, k=rng.randrange(30)) + words + rng.choices(vocabulary, k=rng.randrange(30))
        docs.append((doc_id, ", ".join(words).upper()))
        for other, its in items:
            if least_edits(its.split(), words) <= int(decontaminate.SHARE * len(its.split())):
                expected.add((doc_id, other))
    found = decontaminate.find_leaks(workers.createDataFrame(docs, "doc_id long, text string"), workers.createDataFrame(items, "item_id long, text string"))
    rows = found.collect()
    assert {(r.doc_id, r.item_id) for r in rows} <= expected
    assert len(rows) >= 0.98 * len(expected) and len(expected) > 80
    by_id = dict(docs), dict(items)
    for r in rows:
        assert r.edits == least_edits(by_id[1][r.item_id].split(), by_id[0][r.doc_id].lower().split(", "))


def test_long_items_at_the_edit_limit():
    rng = random.Random(8)
    for n in (120, 250, 500, 1000):
        items = [rng.choices([f"v{k}" for k in range(5000)], k=n) for _ in range(12)]
        docs = []
        for words in items:
            edited = list(words)
            for _ in range(n // 5):
                p = rng.randrange(len(edited))
                kind = rng.randrange(3)
                edited[p : p + (kind > 0)] = ["new"] * (kind < 2)
            docs.append(" ".join(rng.choices(words, k=30) + edited + ["end"] * 30))
        expected = {k for k, words in enumerate(items) if least_edits(words, docs[k].split()) <= n // 5}
        found = decontaminate.Items(list(range(len(items))), [" ".join(x) for x in items]).meet(pa.array(docs))
        assert {(d, k) for d, k, *_ in found} == {(k, k) for k in expected} and len(expected) == len(items)
        assert n > 250 or all(edits == least_edits(items[k], docs[d].split()) for d, k, edits, _, _ in found)


def test_short_items_and_unspaced_scripts():
    items = ["Photosynthesis requires chlorophyll!", "word0x0", "東京の夏はとても暑くて湿度が高いです。", "ประเทศไทยมีประชากรจำนวนมาก", "𠀀𠀁𠀂𠀃𠀄𠀅", "東京"]
    docs = [
        "they say photosynthesis, requires: chlorophyll and word0x0",
        "photosynthesis never requires chlorophyll",
        "去年聞いた話では「東京の夏はとても暑くて、湿度が高いです」とのこと",
        "東京の冬はとても寒くて湿度が高いです",
        "東京の冬はとても暑くて湿度が低いです",
        "คนรู้ว่าประเทศไทยมีประชากรจำนวนมากจริง",
        "x𠀀𠀁𠀂𠀃𠀄𠀅y 東京",
        None,
    ]
    searched = decontaminate.Items(list(range(len(items))), items)
    found = [(x[0], searched.ids[x[1]], *x[2:]) for x in searched.meet(pa.array(docs))]
    assert [x[:3] for x in found] == [(0, 0, 0), (2, 2, 0), (3, 2, 2), (4, 2, 2), (5, 3, 0), (6, 4, 0)]
    assert [x[3:] for x in found if x[0] in (0, 6)] == [(2, 3), (1, 6)]


def test_leaks_of_odd_rows(workers, odd_docs, no_docs, monkeypatch):
    items = workers.createDataFrame([(1, PASSAGE), (1, PASSAGE), (None, PASSAGE), (2, None), (3, ""), (4, "x"), (5, "word0x0")], "item_id long, text string")
    monkeypatch.setattr(decontaminate, "PASS_ITEMS", 2)
    found = decontaminate.find_leaks(odd_docs, items).collect()
    assert Counter((r.doc_id, r.item_id) for r in found) == Counter({(d, i): n for d in (6, 7, None) for i, n in ((1, 2), (None, 1))})
    assert all((r.edits, r.n_words) == (0, 60) for r in found)
    kept = decontaminate.drop_leaks(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.count() == len(ROWS) - 3
    assert decontaminate.drop_leaks(odd_docs, items.where("1 = 0")).count() == len(ROWS)
    assert decontaminate.find_leaks(odd_docs, items.where("1 = 0")).count() == 0
    assert decontaminate.find_leaks(no_docs, items).count() == 0


def test_leaks_are_those_of_exact_passages(spark, sf_dir):
    texts = texts_of(spark, sf_dir)
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    found = {(r.doc_id, r.item_id) for r in queries.QUERIES["op4_cgk_decontamination"](spark, sf_dir).collect()}
    assert {(d, i) for d, t in texts.items() for i, x in items.items() if x in (t or "")} <= found

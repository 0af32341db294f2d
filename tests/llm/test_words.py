import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from linkweft.llm import words as W

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\t\x0b\x1céß東 ", max_size=60)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    found = W.split(pa.array(texts, pa.string()))
    expected = [WORD.findall(t or "") for t in texts]
    assert found.counts.tolist() == [len(w) for w in expected]
    flat = [w for words in expected for w in words]
    assert [bytes(found.data[a:b]).decode() for a, b in zip(found.starts, found.ends)] == flat
    by_word: dict = {}
    for word, h in zip(flat, W.hashes(found)):
        assert by_word.setdefault(word, h) == h
    assert len(set(by_word.values())) == len(by_word)


@pytest.mark.parametrize("size", [1, 2, 3, 5, 25, 50])
def test_window_hash_is_the_polynomial(size):
    values = np.random.default_rng(1).integers(0, 1 << 63, 80, dtype=np.uint64)
    found = W.windows(values, size)
    assert len(found) == 80 - size + 1
    for start in (0, 3, len(found) - 1):
        h = 0
        for v in values[start : start + size]:
            h = (h * W.BASE + int(v)) % (1 << 64)
        assert h == int(found[start])


def test_slices_cover_every_row_once():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * k for k in range(50)]), pa.array(range(50))], ["text", "k"])
    cut = list(W.slices([batch.slice(3), batch.slice(0, 0)], "text", 100))
    assert [k for part in cut for k in part.column("k").to_pylist()] == list(range(3, 50))
    assert all(part.num_rows == 1 or sum(map(len, part.column("text").to_pylist())) <= 100 for part in cut)

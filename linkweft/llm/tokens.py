"""Token ids of whole texts, one tokenizer call per distinct word.

The vocabulary file splits at white space before it merges, and the strings of its special
tokens hold none, so the ids of a text are the ids of its words in order.  A worker keeps the ids of the words it has met.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from linkweft.llm import words as W

# Words a worker keeps before it starts anew; bounds its memory (about 40 bytes a word).
KEPT_WORDS = 2_000_000


class WordTokens:
    """Ids of words, kept as one flat array with sorted word hashes."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)
        self.offset = np.zeros(0, dtype=np.int64)
        self.length = np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.uint32)

    def _learn(self, hashes: np.ndarray, spellings: list[str]) -> None:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(spellings, add_special_tokens=False)]
        length = np.array([len(i) for i in ids], dtype=np.int64)
        flat = np.array([x for i in ids for x in i], dtype=np.uint32)
        offset = len(self.flat) + np.cumsum(length) - length
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known, kind="stable")
        self.known = known[order]
        self.offset = np.concatenate([self.offset, offset])[order]
        self.length = np.concatenate([self.length, length])[order]
        self.flat = np.concatenate([self.flat, flat])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of ids of each (null: none)."""
        if len(self.known) > KEPT_WORDS:
            self.clear()
        words = W.split(texts)
        found, first, back = np.unique(W.hashes(words), return_index=True, return_inverse=True)
        new = ~np.isin(found, self.known, assume_unique=True)
        if new.any():
            raw = words.data.tobytes()
            self._learn(found[new], [raw[words.starts[k] : words.ends[k]].decode() for k in first[new]])
        place = np.searchsorted(self.known, found)[back]
        length = self.length[place]
        flat = self.flat[W.ragged(self.offset[place], length)]
        before = np.concatenate([[0], np.cumsum(length)])
        return flat, np.diff(before[words.first])


_loaded: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """The tokenizer of this worker for a vocabulary file, loaded once."""
    if path not in _loaded:
        _loaded[path] = WordTokens(path)
    return _loaded[path]

"""Hashed word and character n-grams of many texts at once, as NumPy triples."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from linkweft.llm import words as W

# Slots of the hashed features.
BITS = 18


def ngrams(texts: pa.Array, word_sizes=(1, 2), char_sizes=(4,), bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, feature, count) of every distinct feature of every text, in text order.

    Words are runs between ASCII white space; character n-grams are runs of bytes and
    may hold white space.  Four words in a row also give the pattern of which of them are
    equal, which tells repeated words whatever they are.  A text without any n-gram has
    no triple.
    """
    words = W.split(texts)
    h, owner = W.hashes(words), words.text_of()
    keys = []
    for size in word_sizes:
        at = W.inside_text(words, size)
        keys.append(_slot(owner[at], W.mix(W.windows(h, size)[at] + np.uint64(size)), bits))
    at = W.inside_text(words, 4)
    pattern = np.zeros(len(at), dtype=np.uint64)
    for a, b in ((0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3)):
        pattern = pattern * np.uint64(2) + (h[at + a] == h[at + b])
    keys.append(_slot(owner[at], W.mix(pattern + np.uint64(0xA5 << 48)), bits))
    data, ends = W.text_bytes(texts)
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eight = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
    lengths = np.diff(ends)
    for size in char_sizes:
        here = np.maximum(lengths - size + 1, 0)
        at = W.ragged(ends[:-1], here)
        grams = eight[at] & np.uint64((1 << (8 * size)) - 1)
        keys.append(_slot(np.repeat(np.arange(len(lengths)), here), W.mix(grams + np.uint64(size << 56)), bits))
    keys, counts = np.unique(np.concatenate(keys), return_counts=True)
    return keys >> bits, keys & ((1 << bits) - 1), counts


def _slot(owner: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    return (owner.astype(np.int64) << bits) | (h >> np.uint64(64 - bits)).astype(np.int64)

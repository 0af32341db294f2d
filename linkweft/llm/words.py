"""Words of whole Arrow string arrays as NumPy arrays: spans, hashes, window hashes.

Everything works on the UTF-8 bytes of many texts at once, so a task spends no
Python step per word.  Batches are cut by bytes, which bounds a task's memory.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes of text worked on at once; a longer text is one slice of its own.
SLICE_BYTES = 1 << 20

# Odd multipliers of the hashes (fixed values).
MIX = np.uint64(0x9E3779B97F4A7C15)
MIX2 = np.uint64(0xD6E8FEB86659FD93)
BASE = 0xD1342543DE82EF95

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

# Everything but ASCII letters and digits ends a word; bytes of other scripts do not.
NOT_ALNUM = np.ones(256, dtype=bool)
for _first, _last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    NOT_ALNUM[_first : _last + 1] = False

# Code points of scripts written without spaces, and of their punctuation (first, last).
UNSPACED = np.array(
    [(0x0E00, 0x109F), (0x1780, 0x17FF), (0x19E0, 0x19FF), (0x3005, 0x3007), (0x3021, 0x302F), (0x3031, 0x30FA), (0x30FC, 0x312F)]
    + [(0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1B000, 0x1B16F), (0x20000, 0x3FFFF)]
)
PUNCTUATION = np.array([(0x3000, 0x3004), (0x3008, 0x3020), (0x3030, 0x3030), (0x30FB, 0x30FB), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65)])


@dataclass
class Words:
    """Byte spans of words; the words of text d are first[d] to first[d + 1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The number of the text each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each piece have about `limit` bytes at most."""
    for batch in batches:
        ends = _offsets(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def _offsets(texts: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    if len(texts) == 0:
        return np.zeros(1, dtype=np.int64)
    offsets = np.frombuffer(texts.buffers()[1], dtype=kind)
    return offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and the ends between them (null: empty)."""
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = _offsets(texts)
    buffer = texts.buffers()[2] if len(texts) else None
    if buffer is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    data = np.frombuffer(buffer, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def split(texts: pa.Array, separators: np.ndarray = WHITE, unspaced: bool = False) -> Words:
    """Words of every text: the longest runs of bytes that are no separators.

    With `unspaced`, every code point of a script written without spaces is a word of its
    own, and the punctuation of these scripts separates.
    """
    data, offsets = text_bytes(texts)
    inside = ~separators[data]
    if separators is NOT_ALNUM:
        # General punctuation (U+2000 to U+206F): three bytes, of which two are fixed.
        lead = np.flatnonzero((data[:-2] == 0xE2) & ((data[1:-1] == 0x80) | (data[1:-1] == 0x81))) if len(data) > 2 else []
        for k in range(3):
            inside[np.asarray(lead, dtype=np.int64) + k] = False
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    if unspaced:
        lead = np.flatnonzero(data >= 0xE0)
        four = data[lead] >= 0xF0
        point = (data[lead] & np.where(four, 7, 15)).astype(np.int64)
        for k in (1, 2, 3):
            more = (k < 3) | four
            point[more] = (point[more] << 6) | (data[lead[more] + k] & 63)
        size = 3 + four
        alone, apart = _within(point, UNSPACED), _within(point, PUNCTUATION)
        edge[lead[alone]] = edge[(lead + size)[alone]] = True
        inside[ragged(lead[apart], size[apart])] = False
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    return Words(data, starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets))


def _within(values: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    at = np.searchsorted(ranges[:, 0], values, side="right") - 1
    return (at >= 0) & (values <= ranges[np.maximum(at, 0), 1])


def hashes(words: Words) -> np.ndarray:
    """A 64-bit hash per word, from its bytes, eight at a time."""
    lengths = words.ends - words.starts
    padded = np.concatenate([words.data, np.zeros(8, dtype=np.uint8)])
    eight = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
    out = lengths.astype(np.uint64) * MIX
    at, left, who = words.starts, lengths, None
    while len(at):
        part = eight[at]
        short = left < 8
        part[short] &= (np.uint64(1) << (left[short] * 8).astype(np.uint64)) - np.uint64(1)
        if who is None:
            out = mix(out ^ part)
            who = np.flatnonzero(left > 8)
        else:
            out[who] = mix(out[who] ^ part)
            who = who[left > 8]
        at, left = words.starts[who] + (lengths[who] - _rest(left)), _rest(left)
    return out


def _rest(left: np.ndarray) -> np.ndarray:
    return left[left > 8] - 8


def mix(x: np.ndarray) -> np.ndarray:
    x = x * MIX
    x ^= x >> np.uint64(32)
    x *= MIX2
    x ^= x >> np.uint64(29)
    return x


def windows(values: np.ndarray, size: int) -> np.ndarray:
    """Rabin-Karp hash (modulo 2^64) of every `size` consecutive values.

    Windows are joined from halves: hash(a + b) = hash(a) * BASE^len(b) + hash(b).
    """
    total = len(values) - size + 1
    if total <= 0:
        return np.zeros(0, dtype=np.uint64)
    out, have, power, length = None, 0, values, 1
    while True:
        if size & length:
            if out is None:
                out, have = power, length
            else:
                shift = np.uint64(pow(BASE, have, 1 << 64))
                n = len(out) - length
                out = power[:n] * shift + out[length:]
                have += length
        length *= 2
        if length > size:
            break
        half = length // 2
        power = power[: len(power) - half] * np.uint64(pow(BASE, half, 1 << 64)) + power[half:]
    return out[:total]


def inside_text(words: Words, size: int) -> np.ndarray:
    """Start positions of windows of `size` words which lie within one text."""
    counts = words.counts
    here = np.maximum(counts - size + 1, 0)
    return ragged(words.first[:-1], here)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for every (start, length), one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)

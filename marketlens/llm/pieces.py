"""Words of byte arrays of any length, found piece by piece, and byte-exact look-up of words in a fixed vocabulary."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from marketlens.llm.common import _LOWER, mixed

# Bytes of text that are looked at in one vectorised step. A longer word is looked at whole.
PIECE_BYTES = 1 << 20


def windows(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Parts of about ``most`` bytes that cut no word: each ends where a text does, or before a byte that is in no word."""
    start, total = 0, len(data)
    while start < total:
        end = min(start + most, total)
        while end < total:
            stretch = data[end : end + 65_536]
            stop = np.flatnonzero(~inside[stretch])
            near = int(offsets[np.searchsorted(offsets, end)])
            end = min(near, end + (int(stop[0]) if len(stop) else len(stretch)))
            if len(stop) or end == near:
                break
        yield start, end
        start = end


def words_between(
    data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, start: int, end: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end (within the window) and text number of every word of a window."""
    flags = np.zeros(end - start + 2, bool)
    flags[1:-1] = inside[data[start:end]]
    cuts = np.zeros(end - start + 1, bool)
    cuts[offsets[np.searchsorted(offsets, start) : np.searchsorted(offsets, end, "right")] - start] = True
    starts = np.flatnonzero(flags[1:-1] & (~flags[:-2] | cuts[:-1]))
    ends = np.flatnonzero(flags[1:-1] & (~flags[2:] | cuts[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts + start, "right") - 1


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one number; zeros beyond the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", buffer=padded, strides=(1,))


_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def word_keys(eights: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span's length and its first and last eight bytes: all of it, where it has no more than sixteen."""
    length = ends - starts
    first = eights[starts] & _MASK[np.minimum(length, 8)]
    last = np.where(length > 8, eights[np.maximum(ends - 8, starts)], np.uint64(0))
    return mixed(first ^ mixed(last + length.astype(np.uint64)))


def equal_spans(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray, other_start: np.ndarray, other_length: np.ndarray
) -> np.ndarray:
    """Whether each span of ``data`` has the bytes of its span of ``other``, compared eight bytes at a time."""
    length, eights, others = ends - starts, _eights(data), _eights(other)
    same = length == other_length
    going, done = np.flatnonzero(same), 0
    while len(going):
        rest = _MASK[np.minimum(length[going] - done, 8)]
        differ = (eights[starts[going] + done] ^ others[other_start[going] + done]) & rest != 0
        same[going[differ]] = False
        done += 8
        going = going[~differ & (length[going] > done)]
    return same


def distinct_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One span of each distinct content, and for every span which of them it equals. Spans are compared byte by byte."""
    _, one, group = np.unique(word_keys(_eights(data), starts, ends), return_index=True, return_inverse=True)
    like = one[group]
    if not equal_spans(data, starts, ends, data, starts[like], (ends - starts)[like]).all():  # contents with equal hashes
        raw, seen = data.tobytes(), {}
        group = np.array([seen.setdefault(raw[a:b], len(seen)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], np.int64)
        _, one = np.unique(group, return_index=True)
    return one, group


class Vocabulary:
    """Words (bytes, A-Z lower-cased) and their numbers. A word is found by a hash and then compared byte by byte.

    Words whose hashes are equal lie in different layers, each of which is asked.
    """

    def __init__(self, words: list[bytes]):
        self.size = len(words)
        self.length = np.array([len(w) for w in words], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(words), np.uint8)
        self.layers = []
        if not words:
            return
        keys = word_keys(_eights(self.data), self.start, self.start + self.length)
        left = np.argsort(keys, kind="stable")
        while len(left):
            fresh = np.r_[True, keys[left[1:]] != keys[left[:-1]]]
            self.layers.append((keys[left[fresh]], left[fresh]))
            left = left[~fresh]

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the spans of ``data`` are words of the vocabulary, and the numbers of those."""
        if not self.size or not len(starts):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        short = np.flatnonzero(ends - starts <= int(self.length.max()))
        starts, ends = starts[short], ends[short]
        lower = _LOWER[data]
        keys = word_keys(_eights(lower), starts, ends)
        number = np.full(len(starts), -1, np.int64)
        for sorted_keys, ids in self.layers:
            at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
            maybe = np.flatnonzero((sorted_keys[at] == keys) & (number < 0))
            same = ids[at[maybe]]
            equal = equal_spans(lower, starts[maybe], ends[maybe], self.data, self.start[same], self.length[same])
            number[maybe[equal]] = same[equal]
        hit = np.flatnonzero(number >= 0)
        return short[hit], number[hit]

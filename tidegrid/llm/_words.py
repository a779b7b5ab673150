"""Words of many texts at once: numpy over the bytes of an Arrow column.

A ``Words`` holds the words of a run of whole texts. Word and window hashes come from prefix sums,
so a byte costs a few vector operations whatever the window. Texts are UTF-8; all separators are
ASCII bytes, so working on bytes gives the same words as working on characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are handled in one go; a longer text is handled alone.
CHUNK = 1 << 18

_BASE = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(which)
    if have is None or len(have[0]) < n:
        size = max(n, CHUNK + (1 << 16))
        steps = np.ones((2, size), np.uint64)
        steps[0, 1:] = _BASE[which] | 1
        steps[1, 1:] = pow(_BASE[which] | 1, -1, 1 << 64)
        have = _POWERS[which] = tuple(np.cumprod(steps, axis=1, dtype=np.uint64))
    return have


def _rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int) -> np.ndarray:
    """The hash of values[start:end] for each pair."""
    up, down = _powers(which, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of the bytes start to end - 1 for each pair."""
    return _rolling(_TABLES[False, 0][data], starts, ends, 0)


def equal_spans(data: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> bool:
    """Whether the bytes at a and at b are the same for each of the lengths."""
    total = int(lengths.sum())
    if not total:
        return True
    ahead = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    within = np.arange(total) - np.repeat(ahead, lengths)
    return bool((data[np.repeat(a, lengths) + within] == data[np.repeat(b, lengths) + within]).all())


def _table(fold: bool, which: int) -> np.ndarray:
    table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE[1 - which]))
    if fold:
        table[65:91] = table[97:123]
    return table


_TABLES = {(fold, which): _table(fold, which) for fold in (False, True) for which in (0, 1)}

#: Bytes that are in words: what is not ASCII white space; or what is an ASCII letter or digit, or not ASCII.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


class Words:
    """The words of texts whose bytes lie in ``data``, text i in data[offsets[i]:offsets[i + 1]]."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray = NOT_SPACE, fold: bool = False):
        self.data, self.offsets, self.fold = data, offsets, fold
        mask = np.zeros(len(data) + 2, np.int8)
        mask[1:-1] = in_word[data]
        step = np.diff(mask)
        begins, stops = step[:-1] == 1, step[1:] == -1
        inner = offsets[1:-1]
        inner = inner[(inner > 0) & (inner < len(data))]
        touching = inner[(mask[inner + 1] == 1) & (mask[inner] == 1)]  # a text ends and the next begins within a word
        begins[touching] = True
        stops[touching - 1] = True
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.start, offsets)  # text i has words first[i]:first[i + 1]
        self.n = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self.n)), self.n)
        self._hash: dict[int, np.ndarray] = {}

    def hashes(self, which: int = 0) -> np.ndarray:
        if which not in self._hash:
            self._hash[which] = _rolling(_TABLES[self.fold, which][self.data], self.start, self.end, which)
        return self._hash[which]

    def prefix_hashes(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The words of n bytes at least, and the hashes of their first n bytes."""
        own = np.flatnonzero(self.end - self.start >= n)
        return own, mix(_rolling(_TABLES[self.fold, 0][self.data], self.start[own], self.start[own] + n, 0) ^ np.uint64(n))

    def windows(self, k: int) -> np.ndarray:
        """Words at which a window of k words of one text starts."""
        return np.flatnonzero(np.arange(len(self.start)) + k <= self.first[1:][self.doc]) if len(self.start) else np.zeros(0, np.int64)

    def window_hashes(self, starts: np.ndarray, k: int, which: int = 0) -> np.ndarray:
        return _rolling(self.hashes(which), starts, starts + k, which)

    def range_hashes(self, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
        """The hash of words start to end - 1 for each pair."""
        return _rolling(self.hashes(which), starts, ends, which)

    def joined(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of these words (places, rising), joined by one space within a text, and each word's place in them."""
        sizes = self.end[words] - self.start[words]
        space = np.zeros(len(words), np.int64)
        space[:-1] = self.doc[words[1:]] == self.doc[words[:-1]]
        at = np.concatenate([[0], np.cumsum(sizes + space)])
        out = np.full(at[-1], 32, np.uint8)
        ahead = np.concatenate([[0], np.cumsum(sizes)])
        within = np.arange(ahead[-1]) - np.repeat(ahead[:-1], sizes)
        out[np.repeat(at[:-1], sizes) + within] = self.data[np.repeat(self.start[words], sizes) + within]
        return out, at

    def numbers(self) -> np.ndarray:
        """A number for each word, the same for equal ones only."""
        h, lengths = self.hashes(), self.end - self.start
        _, pick, own = np.unique(h, return_index=True, return_inverse=True)
        if (lengths == lengths[pick][own]).all() and equal_spans(self.data, self.start, self.start[pick][own], lengths):
            return own
        seen: dict[bytes, int] = {}  # unlike words have one hash
        return np.array([seen.setdefault(self.text(k, k + 1), len(seen)) for k in range(len(h))], np.int64)

    def text(self, first: int, last: int) -> bytes:
        """Words first to last - 1 as they stand, joined by one space."""
        return b" ".join(self.data[a:b].tobytes() for a, b in zip(self.start[first:last], self.end[first:last], strict=True))


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``size`` bytes: first row, last row + 1, bytes, offsets from 0. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        last = min(last, len(column))
        yield row, last, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values; len(values) - width + 1 of them."""
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[: len(values) - (width - done)], values[width - done :]) if done < width else values


def covered(starts: np.ndarray, lengths: np.ndarray | int, n: int) -> np.ndarray:
    """Which of n places lie in one of the ranges."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + lengths, -1)
    return np.cumsum(step[:-1]) > 0

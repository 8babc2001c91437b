"""Words and shingles of many texts at once, as numpy arrays over their UTF-8 bytes.

All separators are ASCII, so bytes can be looked at one by one. A word's hash is a polynomial over its bytes, taken
from one running sum, then mixed; A-Z counts as lower case.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20  # bytes worked on at a time
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_STEPS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)

_byte = np.arange(256)
LOWER = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, _byte).astype(np.uint64) + np.uint64(1)
#: Bytes of words: all but ASCII white space; letters, digits and everything beyond ASCII.
SPACED = ~((_byte == 32) | ((_byte >= 9) & (_byte <= 13)))
PLAIN = (_byte >= 128) | ((_byte >= 48) & (_byte <= 57)) | ((_byte >= 65) & (_byte <= 90)) | ((_byte >= 97) & (_byte <= 122))

_powers: dict[str, np.ndarray] = {}


def _power_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["up"]) < size:
        size = max(size, CHUNK + 1)
        for name, factor in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (splitmix)."""
    values = values ^ (values >> np.uint64(30))
    values = values * _MIX[0]
    values ^= values >> np.uint64(27)
    values = values * _MIX[1]
    return values ^ (values >> np.uint64(31))


@dataclass
class Words:
    """The words of some texts in order: `starts` and `ends` are byte places in `data`, `hashes` their hashes; text i
    has the words bounds[i] to bounds[i + 1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray

    def texts(self) -> int:
        return len(self.bounds) - 1

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(self.texts()), np.diff(self.bounds))


def _find(data: np.ndarray, cuts: np.ndarray, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of one piece of bytes; none goes across a cut."""
    up, down = _power_table(len(data) + 1)
    inside = word_bytes[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(LOWER[data] * up[: len(data)], out=sums[1:])
    return starts, ends, mix((sums[ends] - sums[starts]) * down[starts])


def find_words(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray = PLAIN) -> Words:
    """Words of the texts data[offsets[i]:offsets[i + 1]]; long ones are worked through in pieces cut at gaps."""
    parts, at, end = [], int(offsets[0]), int(offsets[-1])
    while at < end:
        stop = min(end, at + CHUNK)
        while stop < end:
            gaps = np.flatnonzero(~word_bytes[data[max(at, stop - 4096) : stop]])
            if len(gaps):
                stop = max(at, stop - 4096) + int(gaps[-1]) + 1
                break
            stop = min(end, stop + CHUNK)  # a single word of that length
        starts, ends, hashes = _find(data[at:stop], offsets - at, word_bytes)
        parts.append((starts + at, ends + at, hashes))
        at = stop
    if not parts:
        empty = np.zeros(0, np.int64)
        return Words(data, empty, empty, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    starts, ends, hashes = (np.concatenate(p) for p in zip(*parts))
    return Words(data, starts, ends, hashes, np.searchsorted(starts, offsets))


def text_chunks(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of rows with about `size` bytes; a null text is empty."""
    texts = column.fill_null("")
    if pa.types.is_string(texts.type):
        texts = texts.cast(pa.large_string())
    _, places, values = texts.buffers()
    offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(values, np.uint8) if values else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        begin = offsets[row]
        yield row, end, data[begin : offsets[end]], offsets[row : end + 1] - begin
        row = end


def shingles(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds) of all runs of `size` words per text; a text of fewer words, but not none, has one."""
    count = np.diff(words.bounds)
    short = (count > 0) & (count < size)
    number = np.where(short, 1, np.maximum(count - size + 1, 0))
    bounds = np.concatenate([[0], np.cumsum(number)])
    owner = np.repeat(np.arange(len(count)), number)
    first = words.bounds[:-1][owner] + np.arange(bounds[-1]) - bounds[:-1][owner]
    padded = np.concatenate([words.hashes, np.zeros(size, np.uint64)])
    total = np.zeros(len(first), np.uint64)
    left = words.bounds[1:][owner] - first
    for i in range(size):
        term = padded[first + i] * _STEPS[i % len(_STEPS)]
        if short.any():
            term[left <= i] = 0
        total += term
    return mix(total), bounds

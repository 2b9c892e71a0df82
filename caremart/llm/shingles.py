"""Word shingles of whole texts as 64-bit hashes, many texts at a time.

Words are runs of bytes that are no ASCII white space, A-Z in lower case. All
of it is array arithmetic over the bytes of a chunk of texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes of text that are worked on together, about.
CHUNK = 1 << 20

_U = np.uint64
_RNG = np.random.default_rng(5)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z hash as a-z
_PLACE = _U(0x9E3779B97F4A7C15)
_PLACE_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers = {1: np.ones(1, np.uint64), -1: np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the input moves every bit of the result."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _power(base: int, size: int) -> np.ndarray:
    """Powers 0 .. size - 1 of the place factor (1) or of its inverse (-1)."""
    if len(_powers[base]) < size:
        steps = np.full(size, _PLACE if base == 1 else _PLACE_INVERSE, dtype=np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps)
    return _powers[base][:size]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word in an array of bytes."""
    space = np.concatenate([[True], _SPACE[data], [True]])
    edge = np.flatnonzero(space[1:] != space[:-1])
    start, end = edge[0::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64), start
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power(1, len(data)), out=sums[1:])
    words = (sums[end] - sums[start]) * _power(-1, len(data))[start]
    return mix(words + (end - start).astype(np.uint64)), start


def _long_words(data: np.ndarray) -> np.ndarray:
    """Word hashes of one long text, in pieces that end at white space."""
    out, start = [], 0
    while start < len(data):
        end = min(start + CHUNK, len(data))
        while end < len(data):
            near = np.flatnonzero(_SPACE[data[end : end + CHUNK]])
            if len(near):
                end += int(near[0])
                break
            end = min(end + CHUNK, len(data))
        out.append(word_hashes(data[start:end])[0])
        start = end
    return np.concatenate([*out, np.zeros(0, np.uint64)])


def _of_words(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingles of one text's words."""
    if not len(words):
        return words
    if len(words) < size:
        whole = np.array([len(words)], np.uint64)
        for w in words:
            whole = mix(whole * _PLACE + w)
        return whole
    total = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        total = total * _PLACE + words[k : k + len(total)]
    return np.unique(mix(total))


def shingle_sets(texts: list[bytes], size: int = 5) -> Iterator[list[np.ndarray]]:
    """Chunks of the texts' shingle sets, in order; without words a set is empty."""
    at = 0
    while at < len(texts):
        if len(texts[at]) > CHUNK:
            words = _long_words(np.frombuffer(texts[at], np.uint8))
            yield [_of_words(words, size)]
            at += 1
            continue
        end, total = at, 0
        while end < len(texts) and (end == at or total + len(texts[end]) <= CHUNK):
            total += len(texts[end]) + 1
            end += 1
        part = texts[at:end]
        data = np.frombuffer(b"\n".join(part), np.uint8)
        words, start = word_hashes(data)
        ends = np.searchsorted(start, np.cumsum([len(t) + 1 for t in part]))
        yield [_of_words(w, size) for w in np.split(words, ends[:-1])]
        at = end

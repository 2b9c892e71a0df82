"""Anchors: places that strings of a given length choose by their own content.

A string of ``length`` bytes chooses the place of the least hash among its
grams of ``GRAM`` bytes, the first one of equal ones. Equal strings choose
equal places. Consecutive strings of a text mostly choose the same place: such
a run, its grams and its bytes are hashed. Two equal strings stand in runs
with the same gram, and all strings of runs with the same hash are equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from caremart.llm.shingles import _power, mix

GRAM = 32
#: Bytes that are worked on together, about; longer texts come in overlapping pieces.
CHUNK = 1 << 20
_U = np.uint64
_BYTE = np.random.default_rng(6).integers(1, 1 << 63, 256, dtype=np.uint64)
_TOP = _U((1 << 64) - 1)
#: The low bits of a hash give way to the place, so that a minimum knows where it is.
_PLACE_BITS = _U(24)
_PLACES = _U((1 << 24) - 1)


class Prefixes:
    """Hashes of any substring of an array of bytes."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * _power(1, len(data)), out=self.sums[1:])
        self.back = _power(-1, len(data) + 1)

    def between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, from prefixes and suffixes of blocks."""
    size = len(values) - width + 1
    blocks = -(-len(values) // width)
    full = np.full(blocks * width, _TOP)
    full[: len(values)] = values
    full = full.reshape(blocks, width)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    behind = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:size], ahead[width - 1 : width - 1 + size])


def runs(data: np.ndarray, start: np.ndarray, end: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """``(text, gram, run, first, count)`` of the runs in joined texts ``data[start:end]``.

    ``first`` is the place in its text where a run's first string starts,
    ``count`` how many strings it has.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none.view(np.uint64), none.view(np.uint64), none, none
    prefixes = Prefixes(data)
    place = np.arange(len(data) - GRAM + 1)
    grams = prefixes.between(place, place + GRAM)
    key = (grams >> _PLACE_BITS << _PLACE_BITS) | place.astype(np.uint64)
    at = (_least(key, length - GRAM + 1) & _PLACES).astype(np.int64)
    # Strings that cross from one text into the next one are none.
    inside = np.zeros(len(at) + 1, np.int32)
    whole = end - start >= length
    np.add.at(inside, start[whole], 1)
    np.add.at(inside, end[whole] - length + 1, -1)
    string = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    if not len(string):
        return none, none.view(np.uint64), none.view(np.uint64), none, none
    at = at[string]
    cut = np.flatnonzero((at[1:] != at[:-1]) | (string[1:] != string[:-1] + 1)) + 1
    first, last = string[np.concatenate([[0], cut])], string[np.concatenate([cut, [len(string)]]) - 1]
    at = at[np.concatenate([[0], cut])]
    run = prefixes.between(first, last + length) ^ mix((at - first).astype(np.uint64))
    text = np.searchsorted(end, first, side="right")
    return text, grams[at], run, first - start[text], last - first + 1


def pieces(texts: list[bytes], length: int) -> Iterator[tuple[int, int, bytes]]:
    """``(text, offset, bytes)``: long texts in pieces of which each string of ``length`` is in one."""
    for k, text in enumerate(texts):
        if len(text) <= CHUNK:
            if len(text) >= length:
                yield k, 0, text
            continue
        for offset in range(0, len(text) - length + 1, CHUNK):
            yield k, offset, text[offset : offset + CHUNK + length - 1]


def chunks(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(text, offset, bytes, start, end)`` of pieces that are joined, about ``CHUNK`` bytes each time."""
    group: list[tuple[int, int, bytes]] = []
    total = 0
    for piece in [*pieces(texts, length), None]:
        if group and (piece is None or total + len(piece[2]) > CHUNK):
            size = np.array([len(p) for _, _, p in group])
            end = np.cumsum(size)
            data = np.frombuffer(b"".join(p for _, _, p in group), np.uint8)
            yield np.array([k for k, _, _ in group]), np.array([o for _, o, _ in group]), data, end - size, end
            group, total = [], 0
        if piece is not None:
            group.append(piece)
            total += len(piece[2])

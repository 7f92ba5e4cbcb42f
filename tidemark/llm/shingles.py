"""Sets of word shingles as 64-bit hashes, computed for many texts at a time.

A to Z become lower case. Words are what lies between spaces and the controls 9 to 13 of
the UTF-8 text. The set of a text has the hashes of its distinct runs of five words; a
text of one to four words has its whole sequence as its one element; a text without words
has the empty set. The 64-bit hashes stand for the shingles themselves.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

WIDTH = 5

# Bytes that are hashed at a time; a longer text is cut behind white space.
PIECE = 1 << 20

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """The finalizer of SplitMix64: a bijection of 64-bit words that spreads all bits."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix64(np.arange(256, dtype=np.uint64))
_ODD = mix64(np.arange(1000, 1000 + WIDTH, dtype=np.uint64)) | np.uint64(1)
_BASE = 0xD6E8FEB86659FD93
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, PIECE + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word."""
    raw = np.frombuffer(data, np.uint8)
    space = _SPACE[raw]
    edge = np.empty(len(raw) + 1, bool)
    edge[0], edge[-1] = not space[0], not space[-1]
    np.not_equal(space[1:], space[:-1], out=edge[1:-1])
    at = np.flatnonzero(edge)
    start, end = at[::2], at[1::2]
    up, down = _powers(len(raw))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up, out=total[1:])
    return start, mix64((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def _pieces(data: bytes) -> Iterator[bytes]:
    """The data cut behind white space, in pieces of about PIECE bytes."""
    start = 0
    while len(data) - start > PIECE:
        cut = next((i for i in range(start + PIECE, len(data)) if _SPACE[data[i]]), len(data))
        yield data[start:cut]
        start = cut
    if start < len(data):
        yield data[start:]


def _of_words(words: np.ndarray) -> np.ndarray:
    """Distinct elements, sorted, of one text's word hashes."""
    if not len(words):
        return words
    width = min(WIDTH, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        total += words[i : len(words) - width + 1 + i] * _ODD[i]
    return np.unique(mix64(total))


def shingle_sets(texts: Sequence[str | None]) -> list[np.ndarray]:
    """The sorted distinct hashes of each text."""
    data = [(t or "").encode("utf-8", "surrogatepass").translate(_LOWER) for t in texts]
    sets: list[np.ndarray] = []
    batch: list[bytes] = []
    size = 0
    for own in data:
        if len(own) > PIECE:
            sets += _batch(batch)
            batch, size = [], 0
            sets.append(_of_words(np.concatenate([_words(p)[1] for p in _pieces(own)])))
            continue
        if size + len(own) >= PIECE:
            sets += _batch(batch)
            batch, size = [], 0
        batch.append(own)
        size += len(own) + 1
    return sets + _batch(batch)


def _batch(data: list[bytes]) -> list[np.ndarray]:
    joined = b" ".join(data)
    if not joined:
        return [np.zeros(0, np.uint64)] * len(data)
    start, words = _words(joined)
    ends = np.cumsum([len(d) + 1 for d in data])
    cuts = np.searchsorted(start, ends)
    return [_of_words(words[a:b]) for a, b in zip(np.r_[0, cuts[:-1]], cuts, strict=True)]

"""Word shingles of whole texts as 64-bit hashes, and their minima under many universal hashes.

Words are runs of bytes other than ASCII white space, with A-Z in lower case.
A group of texts is one byte array; word and shingle hashes are array
operations over it, so no word becomes a Python object.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np

#: Bytes of the texts that are hashed as one array; a longer text is a group of its own.
GROUP_BYTES = 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Positions in a word whose bytes' hashes are looked up.
NEAR = 48
_ODD = [np.uint64(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def byte_hashes(code: np.ndarray, seed: int) -> np.ndarray:
    """Scrambled numbers of ``256 * position + byte``."""
    return mixed(mixed(code + np.uint64((seed + 1) * int(_ODD[0]) % (1 << 64))) * _ODD[1] + BASE)


_TABLES = [byte_hashes(np.arange(NEAR << 8, dtype=np.uint64), seed) for seed in range(2)]


def word_hashes(texts: Sequence[bytes], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, one after another, and where each text's words begin (and the last end).

    A word's is the sum of scrambled numbers, one for each byte at its position
    in the word, so no two words have equal hashes by their structure. ``seed`` 0 and 1
    give hashes that are independent.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    data = _LOWER[np.frombuffer(b"".join(texts), np.uint8)]
    word = ~_SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    inner = edges[:-1][sizes > 0]
    first[inner] = word[inner]
    starts = np.flatnonzero(first)
    last = word.copy()
    last[:-1] &= ~word[1:] | first[1:]
    ends = np.flatnonzero(last) + 1
    place = np.zeros(len(data), np.int64)
    place[starts] = starts
    place = np.arange(len(data)) - np.maximum.accumulate(place)
    code = (place << 8) + data
    value = _TABLES[seed][np.minimum(code, (NEAR << 8) - 1)]
    far = np.flatnonzero(place >= NEAR)
    value[far] = byte_hashes(code[far].astype(np.uint64), seed)
    up = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
    return mixed(up[ends] - up[starts] + (ends - starts).astype(np.uint64) * _ODD[0]), np.searchsorted(starts, edges)


def rolled(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all sequences of ``width`` words, across texts too."""
    out = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        out = mixed(out * _ODD[1] + words[k:len(words) - width + 1 + k])
    return out


def whole(words: np.ndarray) -> np.ndarray:
    """Hash of a sequence of words that is shorter than a shingle."""
    out = np.array([len(words)], np.uint64) * _ODD[2]
    for w in words:
        out = mixed(out * _ODD[1] + w)
    return out


def shingle_sets(texts: Sequence[bytes], width: int = 3, hashed: tuple[np.ndarray, np.ndarray] | None = None) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles; with fewer words the whole sequence is one.

    ``hashed`` are the ``word_hashes`` of the texts, where several widths share them.
    """
    words, at = hashed or word_hashes(texts)
    every = rolled(words, width)
    return [np.unique(every[a:b - width + 1]) if b - a >= width else whole(words[a:b]) if b > a else np.zeros(0, np.uint64)
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def double_sets(texts: Sequence[bytes], width: int = 3) -> list[np.ndarray]:
    """``shingle_sets`` with a second, independent hash for each shingle in a second row: 128 bits in all."""
    words, at = word_hashes(texts)
    others = word_hashes(texts, 1)[0]
    first, second = rolled(words, width), rolled(others, width)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= width:
            s, k = np.unique(first[a:b - width + 1], return_index=True)
            out.append(np.stack([s, second[a:b - width + 1][k]]))
        else:
            out.append(np.stack([whole(words[a:b]), whole(others[a:b])]) if b > a else np.zeros((2, 0), np.uint64))
    return out


def groups(texts: Sequence[str | None]) -> Iterator[list[bytes]]:
    """Encoded texts in groups bounded by bytes."""
    group, held = [], 0
    for t in texts:
        b = (t or "").encode()
        if group and held + len(b) > GROUP_BYTES:
            yield group
            group, held = [], 0
        group.append(b)
        held += len(b)
    if group:
        yield group


class Hashes(NamedTuple):
    """Parameters of a family of universal hashes ``(a x + b) >> 32`` on 64-bit numbers, ``a`` odd."""

    a: np.ndarray
    b: np.ndarray

    @staticmethod
    def family(n: int, seed: int = 1) -> Hashes:
        r = np.random.default_rng(seed)
        return Hashes(r.integers(0, 1 << 64, n, np.uint64, endpoint=False) | np.uint64(1),
                      r.integers(0, 1 << 64, n, np.uint64, endpoint=False))

    def minima(self, values: np.ndarray, step: int = 512) -> np.ndarray:
        """The smallest value of each hash over a set that is not empty."""
        out = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for k in range(0, len(values), step):
            np.minimum(out, (self.a[:, None] * values[None, k:k + step] + self.b[:, None]).min(1), out=out)
        return out >> np.uint64(32)

"""Sets of hashed word shingles, computed for many texts at once.

Words are runs of anything but ASCII white space, with A-Z lowered; a shingle is WORDS (or another number of) words in a row.  A text with
fewer words has its whole sequence as its one shingle, a text without words has none.  Shingles are compared by a
64-bit hash: a word's hash is a polynomial over random values of its bytes, a shingle's mixes its words' in order.
"""

from __future__ import annotations

import numpy as np

WORDS = 5
CHUNK = 1 << 20
_RANDOM = np.random.Generator(np.random.PCG64(20240917))
_VALUE = _RANDOM.integers(0, 2**64, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 5
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_powers: list[np.ndarray] = []


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_table(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        n = max(n, CHUNK + 1)
        _powers[:] = [
            np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, b, np.uint64))))
            for b in (_BASE, pow(_BASE, -1, 2**64))
        ]
    return _powers


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts, and its hash."""
    gap = _SPACE[data]
    start = np.flatnonzero(~gap & np.concatenate(([True], gap[:-1])))
    end = np.flatnonzero(~gap & np.concatenate((gap[1:], [True]))) + 1
    power, inverse = _power_table(len(data))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_VALUE[data] * power[: len(data)], dtype=np.uint64)))
    return start, mixed((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))


def _folded(parts: list[np.ndarray]) -> np.ndarray:
    out = np.full(len(parts[0]), len(parts), np.uint64)
    for p in parts:
        out = mixed(out * np.uint64(0xD6E8FEB86659FD93) + p)
    return out


def _chunk(texts: list[bytes], words: int) -> list[np.ndarray]:
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    begins = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    if not len(data):
        return [np.empty(0, np.uint64) for _ in texts]
    start, word = _words(data)
    first = np.searchsorted(start, begins)
    last = np.append(first[1:], len(start))
    rows = _folded([word[i : len(word) - words + 1 + i] for i in range(words)]) if len(word) >= words else word[:0]
    out = []
    for a, b in zip(first.tolist(), last.tolist()):
        if b - a >= words:
            s = np.sort(rows[a : b - words + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif b > a:
            out.append(_folded([word[i : i + 1] for i in range(a, b)]))
        else:
            out.append(word[:0])
    return out


def shingle_sets(texts: list[bytes | None], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text (UTF-8)."""
    out: list[np.ndarray] = []
    part: list[bytes] = []
    size = 0
    for t in texts:
        t = (t or b"").lower()
        if part and size + len(t) > CHUNK:
            out += _chunk(part, words)
            part, size = [], 0
        part.append(t)
        size += len(t) + 1
    return out + _chunk(part, words) if part else out


def set_key(s: np.ndarray) -> int:
    """A 64-bit key of a set; 0 for the empty one."""
    if not len(s):
        return 0
    total = np.array([np.bitwise_xor.reduce(mixed(s + np.uint64(0x632BE59BD9B4E019)))], np.uint64) + mixed(np.sum(s, keepdims=True, dtype=np.uint64))
    return int(mixed(total + np.uint64(len(s))).view(np.int64)[0]) or 1

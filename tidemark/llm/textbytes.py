"""Whole texts as byte arrays in numpy: chunks of documents, hashes of arbitrary substrings, words."""

from __future__ import annotations

import ctypes
import gc
import secrets
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once, unless one document alone is longer. Arrays over a chunk take some 150 bytes for each.
CHUNK_BYTES = 1 << 19
PRIME = (1 << 61) - 1
BASE = 0x9E3779B97F4A7C15
_P, _M31, _M30 = np.uint64(PRIME), np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers: list[np.ndarray] = []
_prime_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_libc = ctypes.CDLL(None)
#: Tables that a worker keeps from task to task.
kept: list[list | dict] = [_powers, _prime_powers]


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 4096)
        _powers[:] = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers.append(np.cumprod(p))
    return _powers[0][:n], _powers[1][:n]


class Hasher:
    """64-bit hashes of any substrings of a byte array; equal substrings have equal hashes wherever they stand.

    For features of models: unlike strings can be made that share a hash, so nothing else is decided by it.
    """

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.down[start])

    def grams(self, n: int) -> np.ndarray:
        """Hashes of all substrings of length ``n``."""
        return mix64((self.sums[n:] - self.sums[:-n]) * self.down[: len(self.sums) - n])


def draw() -> int:
    """A base for hashes, drawn for one run: nobody can choose texts that collide under it."""
    return secrets.randbelow(PRIME - (1 << 32)) + (1 << 31)


def _folded(x: np.ndarray) -> np.ndarray:
    """Values below 2**63 modulo the prime."""
    x = (x & _P) + (x >> np.uint64(61))
    return x - _P * (x >= _P)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime, in halves of 31 bits."""
    ah, al, bh, bl = a >> np.uint64(31), a & _M31, b >> np.uint64(31), b & _M31
    middle = al * bh + ah * bl
    return _folded(((ah * bh) << np.uint64(1)) + (middle >> np.uint64(30)) + ((middle & _M30) << np.uint64(31)) + al * bl)


def prime_powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the base and of its inverse modulo the prime."""
    if base not in _prime_powers or len(_prime_powers[base][0]) < n:
        size, found = max(n, CHUNK_BYTES + 4096), []
        for b in (base, pow(base, -1, PRIME)):
            p = np.ones(1, np.uint64)
            while len(p) < size:
                p = np.concatenate([p, _times(p, np.full(len(p), pow(b, len(p), PRIME), np.uint64))])
            found.append(p[:size])
        _prime_powers.pop(base, None)
        while len(_prime_powers) > 1:
            del _prime_powers[next(iter(_prime_powers))]
        _prime_powers[base] = tuple(found)
    return _prime_powers[base][0][:n], _prime_powers[base][1][:n]


class KeyedHasher:
    """61-bit hashes of any substrings of a byte array; equal substrings have equal hashes wherever they stand.

    A polynomial in the base modulo the prime 2**61 - 1: two different strings of n bytes share a hash for at most n of all bases, so with a
    base drawn for the run a text can aim at a collision no better than by chance.
    """

    def __init__(self, data: np.ndarray, base: int):
        up, self.down = prime_powers(len(data) + 1, base)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        carry = np.uint64(0)
        for at in range(0, len(data), 1 << 20):
            d, p = data[at : at + (1 << 20)].astype(np.uint64) + np.uint64(1), up[at : min(len(data), at + (1 << 20))]
            low, high = np.cumsum(d * (p & _M31)), np.cumsum(d * (p >> np.uint64(31)))
            self.sums[at + 1 : at + 1 + len(d)] = _folded((high >> np.uint64(30)) + ((high & _M30) << np.uint64(31)) + low + carry)
            carry = self.sums[at + len(d)]

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64(_times(_folded(self.sums[end] + _P - self.sums[start]), self.down[start]))

    def grams(self, n: int) -> np.ndarray:
        """Hashes of all substrings of length ``n``."""
        return mix64(_times(_folded(self.sums[n:] + _P - self.sums[:-n]), self.down[: len(self.sums) - n]))


def trim() -> None:
    """Give freed memory back: a worker lives on for later stages, and allocators would keep what its largest chunk took."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def turn(*own: list | dict) -> None:
    """A worker that turns to other work drops the tables that it kept for the last, all but ``own``."""
    others = [t for t in kept if t and not any(t is o for o in own)]
    for table in others:
        table.clear()
    if others:
        gc.collect()
        trim()


def chunks(texts: Iterable[str | None], before: bytes = b"", after: bytes = b"") -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first text, bytes, bounds)``: whole texts joined into byte arrays; text i of a chunk is bytes bounds[i] to bounds[i + 1]."""
    turn(_powers, _prime_powers)
    held: list[bytes] = []
    size = first = 0
    for at, text in enumerate(texts):
        own = before + (text or "").encode("utf-8", "surrogatepass") + after
        if held and size + len(own) > CHUNK_BYTES:
            yield first, np.frombuffer(b"".join(held), np.uint8), np.cumsum([0, *map(len, held)])
            held, size, first = [], 0, at
        held.append(own)
        size += len(own)
    if held:
        yield first, np.frombuffer(b"".join(held), np.uint8), np.cumsum([0, *map(len, held)])
    trim()


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; other bytes as they are."""
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    edge = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)

"""SHA-256 chaining values of many messages at once, so that hashing can stop, be kept and go on.

A digest in hex is one block of 64 bytes. Hashing a run of digests therefore has
a state of 32 bytes before each of them, which needs no buffer beside it.
"""

from __future__ import annotations

from math import isqrt

import numpy as np

BLOCK = 64  # bytes


def _primes(n: int) -> list[int]:
    found: list[int] = []
    candidate = 2
    while len(found) < n:
        if all(candidate % p for p in found):
            found.append(candidate)
        candidate += 1
    return found


def _cube_root(n: int) -> int:
    root = round(n ** (1 / 3))
    while root**3 > n:
        root -= 1
    while (root + 1) ** 3 <= n:
        root += 1
    return root


# by the standard's rule: first 32 bits of the fractions of square and cube roots of primes
START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], np.uint32)
_ROUNDS = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in _primes(64)], np.uint32)


def _turned(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def advance(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """States (n, 8) after one more block (n, 16) each, both of 32-bit words."""
    w = list(blocks.T.copy())
    for i in range(16, 64):
        a, b = w[i - 15], w[i - 2]
        small = _turned(a, 7) ^ _turned(a, 18) ^ (a >> np.uint32(3))
        large = _turned(b, 17) ^ _turned(b, 19) ^ (b >> np.uint32(10))
        w.append(w[i - 16] + small + w[i - 7] + large)
    first = states.T.copy()
    a, b, c, d, e, f, g, h = first
    for i in range(64):
        turned = _turned(e, 6) ^ _turned(e, 11) ^ _turned(e, 25)
        one = h + turned + ((e & f) ^ (~e & g)) + _ROUNDS[i] + w[i]
        turned = _turned(a, 2) ^ _turned(a, 13) ^ _turned(a, 22)
        two = turned + ((a & b) ^ (a & c) ^ (b & c))
        h, g, f, e, d, c, b, a = g, f, e, d + one, c, b, a, one + two
    return (first + np.stack([a, b, c, d, e, f, g, h])).T.copy()


def closed(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """States of finished messages of so many whole blocks (n): one block of padding is added."""
    padding = np.zeros((len(states), 16), np.uint32)
    padding[:, 0] = 0x80000000
    bits = blocks.astype(np.uint64) * np.uint64(8 * BLOCK)
    padding[:, 14], padding[:, 15] = bits >> np.uint64(32), bits & np.uint64(0xFFFFFFFF)
    return advance(states, padding)


def to_blocks(digests: list[str]) -> np.ndarray:
    """Digests in hex as blocks (n, 16)."""
    return np.frombuffer("".join(digests).encode(), ">u4").reshape(-1, 16).astype(np.uint32)


def to_bytes(states: np.ndarray) -> list[bytes]:
    joined = states.astype(">u4").tobytes()
    return [joined[i : i + 32] for i in range(0, len(joined), 32)]


def from_bytes(states: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(states), ">u4").reshape(-1, 8).astype(np.uint32)


def to_hex(states: np.ndarray) -> list[str]:
    joined = states.astype(">u4").tobytes().hex()
    return [joined[i : i + 64] for i in range(0, len(joined), 64)]

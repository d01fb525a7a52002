"""SHA-256 of many messages at once, with states that can be stored and resumed.

Library hash objects can be copied inside one process but not written down. Here a state is
eight 32-bit words. Every message is a row of digests as hexadecimal text: 64 bytes each, so
one digest fills exactly one block and a state between two of them holds no unfinished block.
"""

from __future__ import annotations

from math import isqrt

import numpy as np

WORD_BYTES = ">u4"


def _primes(n: int) -> list[int]:
    found: list[int] = []
    number = 2
    while len(found) < n:
        if all(number % p for p in found):
            found.append(number)
        number += 1
    return found


def _cube_root(x: int) -> int:
    low, high = 0, 1 << (x.bit_length() // 3 + 1)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if middle**3 <= x else (low, middle - 1)
    return low


# The standard's constants by their rule: bits of the fractions of roots of primes.
START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], dtype=np.uint32)
_ROUNDS = [np.uint32(_cube_root(p << 96) & 0xFFFFFFFF) for p in _primes(64)]


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def absorb(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The states (n, 8) after one more block (n, 16) each."""
    old = np.ascontiguousarray(states.T)
    w = list(np.ascontiguousarray(blocks.T))
    for i in range(16, 64):
        x, y = w[i - 15], w[i - 2]
        small = _turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3))
        large = _turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))
        w.append(w[i - 16] + small + w[i - 7] + large)
    a, b, c, d, e, f, g, h = old
    for constant, word in zip(_ROUNDS, w):
        first = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + constant + word
        second = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        h, g, f, e, d, c, b, a = g, f, e, d + first, c, b, a, first + second
    return (old + np.stack([a, b, c, d, e, f, g, h])).T


def hex_blocks(digests: np.ndarray) -> np.ndarray:
    """The blocks (n, 16) of digests (n, 8): their 64 lower-case hexadecimal digits."""
    halves = np.stack([digests >> np.uint32(16), digests & np.uint32(0xFFFF)], axis=2).reshape(len(digests), 16)
    digits = np.zeros_like(halves)
    for shift in range(4):
        digits |= ((halves >> np.uint32(4 * shift)) & np.uint32(15)) << np.uint32(8 * shift)
    letters = ((digits + np.uint32(0x06060606)) >> np.uint32(4)) & np.uint32(0x01010101)
    return digits + np.uint32(0x30303030) + letters * np.uint32(39)


def finish(states: np.ndarray, blocks_so_far: np.ndarray) -> np.ndarray:
    """The digests (n, 8) of messages that end after so many whole blocks."""
    last = np.zeros((len(states), 16), dtype=np.uint32)
    last[:, 0] = 0x80000000
    last[:, 15] = blocks_so_far * 512
    return absorb(states, last)


def to_words(raw: bytes) -> np.ndarray:
    """Stored digests or states, 32 bytes each, as rows of words."""
    return np.frombuffer(raw, dtype=WORD_BYTES).astype(np.uint32).reshape(-1, 8)


def to_bytes(words: np.ndarray) -> bytes:
    return words.astype(WORD_BYTES).tobytes()

"""SHA-256 over many messages at once, with states that can be kept and resumed.

``hashlib`` can copy a running hash but not write it down. A Merkle parent must
keep its states in a table, so the compression function is stated here over
numpy columns: lane ``i`` of a state is message ``i``. Children enter as 64
characters of hex text, one whole block each, so a state between two children
is eight 32-bit words and nothing else.
"""

from __future__ import annotations

from math import isqrt

import numpy as np

LANES = 4096        # lanes worked on together: the working rows then stay in the processor's cache


def _primes(n: int) -> list[int]:
    found: list[int] = []
    k = 2
    while len(found) < n:
        if all(k % p for p in found):
            found.append(k)
        k += 1
    return found


def _cube_root(x: int) -> int:
    lo, hi = 0, 1 << (x.bit_length() // 3 + 1)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if mid ** 3 <= x else (lo, mid - 1)
    return lo


# Fractional parts of the square and cube roots of the first primes (FIPS 180-4).
START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], np.uint32)
_ROUND = [np.uint32(_cube_root(p << 96) & 0xFFFFFFFF) for p in _primes(64)]
_HEX = np.array([(b"%02x" % i) for i in range(256)], "S2")


def _turn(x: np.ndarray, *by: int) -> np.ndarray:
    """XOR of ``x`` rotated right by each amount."""
    out = None
    for n in by:
        r = (x >> np.uint32(n)) | (x << np.uint32(32 - n))
        out = r if out is None else np.bitwise_xor(out, r, out=out)
    return out


def _compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    w = list(block)
    for i in range(16, 64):
        x, y = w[i - 15], w[i - 2]
        s0, s1 = _turn(x, 7, 18), _turn(y, 17, 19)
        s0 ^= x >> np.uint32(3)
        s1 ^= y >> np.uint32(10)
        s0 += s1
        s0 += w[i - 16]
        s0 += w[i - 7]
        w.append(s0)
    a, b, c, d, e, f, g, h = state
    for k, word in zip(_ROUND, w):
        t = _turn(e, 6, 11, 25)
        t += ((f ^ g) & e) ^ g
        t += h
        t += word
        t += k
        u = _turn(a, 2, 13, 22)
        u += (a & b) | (c & (a | b))
        u += t
        a, b, c, d, e, f, g, h = u, a, b, c, d + t, e, f, g
    return np.stack((a, b, c, d, e, f, g, h)) + state


def absorb(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """States ``(8, n)`` after one more 64-byte block ``(16, n)`` each."""
    n = state.shape[1]
    if n <= LANES:
        return _compress(state, block)
    out = np.empty((8, n), np.uint32)
    for at in range(0, n, LANES):
        out[:, at:at + LANES] = _compress(state[:, at:at + LANES], block[:, at:at + LANES])
    return out


def finish(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Digests ``(8, n)`` of messages of ``blocks`` whole 64-byte blocks each."""
    pad = np.zeros((16, state.shape[1]), np.uint32)
    pad[0] = 0x80000000
    bits = blocks.astype(np.uint64) * np.uint64(512)
    pad[14], pad[15] = (bits >> np.uint64(32)).astype(np.uint32), bits.astype(np.uint32)
    return absorb(state, pad)


def fresh(n: int) -> np.ndarray:
    """``n`` states before any input."""
    return np.repeat(START[:, None], n, axis=1)


def to_bytes(words: np.ndarray) -> np.ndarray:
    """``(8, n)`` words as ``(n, 32)`` bytes."""
    return np.ascontiguousarray(words.T.astype(">u4")).view(np.uint8).reshape(-1, 32)


def to_words(raw: np.ndarray) -> np.ndarray:
    """``(n, 4k)`` bytes as ``(k, n)`` words."""
    return np.ascontiguousarray(np.ascontiguousarray(raw).view(">u4").astype(np.uint32).T)


def hex_text(raw: np.ndarray) -> np.ndarray:
    """``(n, 32)`` bytes as ``(n,)`` texts of 64 hex characters."""
    return np.ascontiguousarray(_HEX[raw]).view("S64").reshape(-1)


def hex_blocks(raw: np.ndarray) -> np.ndarray:
    """``(n, 32)`` digests as the ``(16, n)`` message blocks of their hex text."""
    if not len(raw):
        return np.empty((16, 0), np.uint32)
    return to_words(np.ascontiguousarray(_HEX[raw]).view(np.uint8).reshape(-1, 64))

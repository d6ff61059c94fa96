"""The first 32 bits of MD5 of very many short messages at once."""

from __future__ import annotations

import math

import numpy as np

# Fixed values of the digest: its start, rotations and the sines that are its constants.
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_TURNS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))
_SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_ORDER = (lambda i: i, lambda i: (5 * i + 1) % 16, lambda i: (3 * i + 5) % 16, lambda i: 7 * i % 16)
#: Longest message of one block, and messages that one step works on.
LONGEST, SLAB = 55, 1 << 14


def first_words(messages: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Bytes 0..3 of the digest, as big-endian numbers, of rows of ``messages`` (bytes, zero beyond ``sizes``) of at most LONGEST bytes."""
    n, width = messages.shape
    words = -(-(width + 1) // 4)
    padded = np.zeros((n, 4 * words), np.uint8)
    padded[:, :width] = messages
    padded[np.arange(n), sizes] = 0x80
    block = np.ascontiguousarray(padded.view("<u4").T)
    bits = (sizes * 8).astype(np.uint32)
    out = np.empty(n, np.uint32)
    for lo in range(0, n, SLAB):
        own = slice(lo, lo + SLAB)
        out[own] = _digest([*(w[own] for w in block), *[None] * (14 - words), bits[own], None])
    return out.byteswap()


def _digest(words: list[np.ndarray | None]) -> np.ndarray:
    """The digest's first word; None is a word of zeros."""
    n = len(words[0])
    a, b, c, d = (np.full(n, x, np.uint32) for x in _START)
    f, g = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for i in range(64):
        kind = i // 16
        if kind == 0:
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
        elif kind == 1:
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
        elif kind == 2:
            np.bitwise_xor(b, c, out=f)
            f ^= d
        else:
            np.bitwise_not(d, out=f)
            f |= b
            f ^= c
        f += a
        f += np.uint32(_SINES[i])
        word = words[_ORDER[kind](i % 16)]
        if word is not None:
            f += word
        turn = _TURNS[kind][i % 4]
        np.left_shift(f, np.uint32(turn), out=g)
        f >>= np.uint32(32 - turn)
        g |= f
        g += b
        a, d, c, b, g = d, c, b, g, a  # the old a is the next step's scratch
    return a + np.uint32(_START[0])

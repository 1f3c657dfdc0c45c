"""Hashed character n-grams of whole texts in numpy, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

PIECE = 1 << 20  # code points handled at once; longer texts go through in pieces
MULTIPLIER = np.uint32(0x9E3779B1)
MIX = np.uint32(0x85EBCA6B)


def code_points(text: str) -> np.ndarray:
    """Lower-case code points with a space on either side, so that n-grams see both ends."""
    return np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def gram_hashes(text: str, orders: tuple[int, ...]) -> Iterator[np.ndarray]:
    """32-bit hashes of the n-grams of every order, each n-gram once per occurrence."""
    codes = code_points(text)
    most = max(orders)
    for at in range(0, len(codes), PIECE):
        piece = codes[at : at + PIECE + most - 1]
        rolling = piece * MULTIPLIER
        for n in range(1, most + 1):
            if n > 1:
                rolling = (rolling[:-1] ^ (rolling[:-1] >> np.uint32(15))) * MULTIPLIER + piece[n - 1 :]
            if n in orders:
                h = rolling[:PIECE] ^ (rolling[:PIECE] >> np.uint32(13))  # starts in this piece only
                h = h * MIX + np.uint32(n)
                yield h ^ (h >> np.uint32(16))
            if len(rolling) <= 1:
                break

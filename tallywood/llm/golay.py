"""Nearby codewords of the binary Golay code, for words of 16 bits.

The perfect [23, 12, 7] code: every 23-bit word lies within three bits of exactly one
codeword. A 16-bit word is taken as a 23-bit word whose seven upper bits are zero.
Two words that differ in at most one bit share a key when one of them is keyed by its
own codeword and the other by the codewords of itself and of all words one bit away.
"""

from __future__ import annotations

from functools import cache

import numpy as np

# Fixed value: generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
LENGTH, MESSAGE, SEGMENT = 23, 12, 16


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of words as polynomials over GF(2)."""
    rest = words.astype(np.int64).copy()
    for shift in range(MESSAGE - 1, -1, -1):
        top = (rest >> (shift + 11)) & 1
        rest ^= top * (GENERATOR << shift)
    return rest


@cache
def _leaders() -> np.ndarray:
    """The one error pattern of three bits or fewer for each syndrome."""
    bits = [1 << i for i in range(LENGTH)]
    errors = [0, *bits]
    errors += [a | b for i, a in enumerate(bits) for b in bits[:i]]
    errors += [
        a | b | c for i, a in enumerate(bits) for j, b in enumerate(bits[:i]) for c in bits[:j]
    ]
    patterns = np.array(errors, dtype=np.int64)
    leaders = np.zeros(1 << 11, dtype=np.int64)
    leaders[_syndromes(patterns)] = patterns
    return leaders


def decode(words: np.ndarray) -> np.ndarray:
    """Index (0 to 4095) of the codeword nearest to each 23-bit word."""
    words = words.astype(np.int64)
    return (words ^ _leaders()[_syndromes(words)]) >> 11


@cache
def own_keys() -> np.ndarray:
    """Codeword index of every 16-bit word."""
    return decode(np.arange(1 << SEGMENT))


@cache
def near_keys() -> tuple[np.ndarray, np.ndarray]:
    """Codeword indices of every 16-bit word and of its one-bit neighbours.

    As (starts, values): the distinct indices of word ``w`` are
    ``values[starts[w]:starts[w + 1]]``.
    """
    words = np.arange(1 << SEGMENT)
    own = own_keys()
    near = np.stack([own, *(own[words ^ (1 << i)] for i in range(SEGMENT))], axis=1)
    near.sort(axis=1)
    first = np.ones(near.shape, dtype=bool)
    first[:, 1:] = near[:, 1:] != near[:, :-1]
    starts = np.concatenate([[0], first.sum(axis=1).cumsum()])
    return starts, near[first]

"""Word shingles of whole texts, as hashes in arrays."""

from __future__ import annotations

import numpy as np
import xxhash

from cadence.llm.tokens import BLOCK, _mix, word_hashes

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STEP = np.uint64(0xD6E8FEB86659FD93)
#: Bits of a shingle's hash that tell it from others.
HASH_BITS = 44


def words_of(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of each word; words are parted by ASCII white space."""
    space = _SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[1:-1] = space[1:] != space[:-1]
    edge[ends] = True
    at = np.flatnonzero(edge)
    starts, stops = at[:-1], at[1:]
    kept = ~space[starts]
    starts, stops = starts[kept], stops[kept]
    return starts, stops, np.searchsorted(ends, starts, "right") - 1


def hash_words(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, in blocks; a word longer than a block is hashed by itself."""
    out, k = np.zeros(len(starts), np.uint64), 0
    while k < len(starts):
        j = max(k + 1, int(np.searchsorted(stops, starts[k] + BLOCK, "right")))
        block = data[starts[k] : stops[j - 1]]
        if len(block) > BLOCK:
            out[k] = xxhash.xxh3_64_intdigest(block.tobytes())
        else:
            out[k:j] = word_hashes(block, starts[k:j] - starts[k], stops[k:j] - starts[k])
        k = j
    return out


def shingles(data: np.ndarray, ends: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and count of each different shingle of ``size`` words, by text and hash.

    A text with fewer words has one shingle of them all; one without words has none.
    """
    starts, stops, text = words_of(data, ends)
    word = hash_words(data, starts, stops)
    n = np.bincount(text, minlength=len(ends) - 1)
    whole = np.zeros(max(0, len(word) - size + 1), np.uint64)
    for j in range(size if len(whole) else 0):
        whole = whole * _STEP + word[j : j + len(whole)]
    inside = text[: len(whole)] == text[size - 1 :] if len(whole) else np.zeros(0, bool)
    found, owner = [whole[inside]], [text[: len(whole)][inside]]
    first = np.concatenate([[0], np.cumsum(n)])[:-1]
    for few in range(1, size):
        short = np.flatnonzero(n == few)
        one = np.zeros(len(short), np.uint64)
        for j in range(few):
            one = one * _STEP + word[first[short] + j]
        found.append(one + np.uint64(few))
        owner.append(short)
    value = _mix(np.concatenate(found)) >> np.uint64(64 - HASH_BITS)
    packed = (np.concatenate(owner).astype(np.uint64) << np.uint64(HASH_BITS)) | value
    packed, count = np.unique(packed, return_counts=True)
    return (packed >> np.uint64(HASH_BITS)).astype(np.int64), packed & np.uint64((1 << HASH_BITS) - 1), count

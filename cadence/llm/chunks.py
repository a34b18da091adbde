"""Content-defined chunking with a gear rolling hash, on UTF-8 bytes or on words."""

from __future__ import annotations

import numpy as np

#: Bytes that a hash value depends on: a shift of one bit per byte in 32 bits.
WINDOW = 32
#: Of so many boundaries of words in a row, the one of smallest hash is a cut.
SPREAD = 3


def _gear_table() -> np.ndarray:
    """A 32-bit number for each byte value, by the splitmix64 rule."""
    with np.errstate(over="ignore"):
        x = (np.arange(1, 257, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(31))) >> np.uint64(32)).astype(np.uint32)


GEAR = _gear_table()


def gear_hash(data: np.ndarray) -> np.ndarray:
    """At each byte the sum over the last 32 bytes of gear[byte] << age.

    The sum over 2n bytes is that over n, plus that over the n before, shifted.
    """
    h = GEAR[data]
    for n in (1, 2, 4, 8, 16):
        more = h[:-n] << np.uint32(n)
        h[n:] += more
    return h


def chunk_ends(data: np.ndarray, ends: np.ndarray, bits: int, low: int, high: int) -> tuple[list[int], list[int]]:
    """End of each chunk, and for each text the number of chunks up to its end.

    ``ends`` are the n + 1 offsets of the texts in ``data``. A chunk ends where
    the top ``bits`` bits of the hash are 0, at the start of a character, at
    least ``low`` bytes after the last end; without such a place it ends after
    about ``high`` bytes. A chunk never spans two texts, and the first window
    of a text has no end, so that the text before never decides. An empty
    text has no chunk.
    """
    lead = np.flatnonzero(gear_hash(data) < np.uint32(1 << (32 - bits))) + 1 if len(data) > 1 else np.zeros(0, np.int64)
    lead = lead[lead < len(data)]
    lead = lead[(data[lead] & 0xC0) != 0x80].tolist()
    lead.append(len(data) + high + WINDOW)
    found: list[int] = []
    upto = [0]
    k, at = 0, 0
    for end in ends[1:].tolist():
        first = at + WINDOW
        while at < end:
            least = max(first, at + low)
            while lead[k] < least:
                k += 1
            nxt = lead[k]
            if nxt - at > high:
                nxt = at + high
                while nxt < end and data[nxt] & 0xC0 == 0x80:
                    nxt += 1
            at = min(nxt, end)
            found.append(at)
        upto.append(len(found))
    return found, upto


def word_cuts(word: np.ndarray) -> np.ndarray:
    """Boundaries at which chunks of words begin: i stands between words i and i + 1.

    The gear hash rolls over words, whose own 64-bit hashes are the gear table;
    a shift by half the bits per word leaves the two words at a boundary. A cut
    has the smallest hash (all of them, if equal) of some ``SPREAD`` boundaries
    in a row, so that no so many are without one, and words further away decide
    nothing.
    """
    if len(word) <= SPREAD:
        return np.zeros(0, np.int64)
    gear = (word[:-1] << np.uint64(32)) + word[1:]
    n = len(gear) - SPREAD + 1
    smallest = np.minimum.reduce([gear[j : j + n] for j in range(SPREAD)])
    cut = np.zeros(len(gear), bool)
    for j in range(SPREAD):
        cut[j : j + n] |= gear[j : j + n] == smallest
    return np.flatnonzero(cut)


def word_chunks(word: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray]:
    """The boundary before each chunk, and its number of words.

    From each cut a chunk runs to the first cut that is ``low`` words away or
    more, which is less than ``low + SPREAD``. Chunks overlap, so that some
    chunk of any ``low + 4 * SPREAD - 2`` words is the same whatever stands
    around them.
    """
    cuts = word_cuts(word)
    end = np.searchsorted(cuts, cuts + low)
    whole = end < len(cuts)
    return cuts[whole], cuts[end[whole]] - cuts[whole]

"""Exact tokenization with the ``tokenizers`` library, a word at a time.

A word's ids do not depend on its neighbours where words are parted at places
that the tokenizer always parts at. So each worker keeps the ids of the words
that it has met in a table of fixed size, and the library sees a word only
once. Words are found, hashed, looked up and joined as arrays.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

#: Words that a worker remembers (beyond it the table starts anew) and its slots.
MEMO_WORDS, SLOT_BITS = 1_500_000, 22
#: Bytes of text whose words are hashed together.
BLOCK = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 13, 32]] = True
#: Marks that the tokenizers part from a Latin letter on either side.
_MARK = np.zeros(256, bool)
_MARK[list(b".,!")] = True
_LETTER = np.zeros(256, bool)
_LETTER[list(range(65, 91)) + list(range(97, 123))] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_PRIME = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finisher."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = [_mix(np.arange(1 + 256 * k, 257 + 256 * k, dtype=np.uint64) * np.uint64(_PRIME)) for k in (0, 1)]


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    inverse = pow(_PRIME, -1, 1 << 64)
    up, down = np.full(n, _PRIME, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: int = 0) -> np.ndarray:
    """A 64-bit polynomial hash of data[start:end] for each word; words lie within a block."""
    up, down = _powers(BLOCK)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[kind][data] * up[: len(data)], out=total[1:])
    return _mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Memo:
    """Word hash -> ids, in arrays: open addressing, and the ids of all words in one array."""

    def __init__(self):
        self.mask = np.uint64((1 << SLOT_BITS) - 1)
        self.clear()

    def clear(self) -> None:
        self.key = np.zeros(1 << SLOT_BITS, np.uint64)
        self.check = np.zeros(1 << SLOT_BITS, np.uint32)
        self.at = np.full(1 << SLOT_BITS, -1, np.int32)
        self.first = np.zeros(1024, np.int64)
        self.count = 0
        self.ids = np.zeros(4096, np.uint32)
        self.size = 0

    def find(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Number of each word, or -1."""
        found = np.full(len(key), -1, np.int32)
        slot = key & self.mask
        todo = np.arange(len(key))
        while len(todo):
            at = self.at[slot]
            hit = (self.key[slot] == key[todo]) & (self.check[slot] == check[todo]) & (at >= 0)
            found[todo[hit]] = at[hit]
            go = ~hit & (at >= 0)
            todo, slot = todo[go], (slot[go] + np.uint64(1)) & self.mask
        return found

    def add(self, key: np.ndarray, check: np.ndarray, ids: list[list[int]]) -> None:
        """Words that are not there yet, each once."""
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.array([x for word in ids for x in word], np.uint32)
        while self.size + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.uint32)])
        while self.count + len(key) + 1 > len(self.first):
            self.first = np.concatenate([self.first, np.zeros(len(self.first), np.int64)])
        self.ids[self.size : self.size + len(flat)] = flat
        self.first[self.count + 1 : self.count + len(key) + 1] = self.size + np.cumsum(n)
        number = np.arange(self.count, self.count + len(key), dtype=np.int32)
        self.size += len(flat)
        self.count += len(key)
        slot, todo = key & self.mask, np.arange(len(key))
        while len(todo):
            free = np.flatnonzero(self.at[slot] < 0)
            _, one = np.unique(slot[free], return_index=True)
            won = free[one]
            self.key[slot[won]], self.check[slot[won]], self.at[slot[won]] = key[todo[won]], check[todo[won]], number[todo[won]]
            lost = np.ones(len(todo), bool)
            lost[won] = False
            todo, slot = todo[lost], (slot[lost] + np.uint64(1)) & self.mask

    def join(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words' ids one after another, and how many each word has."""
        first = self.first[number]
        n = self.first[number + 1] - first
        ends = np.cumsum(n)
        place = np.repeat(first - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)
        return self.ids[place], n


class Encoder:
    """Encodes texts exactly as the library does for the whole text.

    ``spaced``: whether the tokenizer keeps the space before a word (byte-level
    vocabularies) or drops white space (vocabularies with word ends). Texts
    are parted at the start of each run of ASCII white space, which the second
    kind drops; runs in which a space follows other white space mean something
    to the first kind, so such texts go to the library whole. Both kinds part
    Latin letters from sentence marks. Special-token strings inside a text are
    found as the library finds them: they hold none of these places.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.spaced = self.library([" a"]) != self.library(["a"])
        self.lowers = not self.spaced and self.library(["A"]) == self.library(["a"])
        self.memo = Memo()

    def library(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _words(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each word in the texts that end at ``ends``."""
        begin = np.zeros(len(data) + 1, bool)
        begin[ends] = True
        space, mark, letter = _SPACE[data], _MARK[data], _LETTER[data]
        begin[1:-1] |= (space[1:] & ~space[:-1]) | (mark[1:] & letter[:-1]) | (letter[1:] & mark[:-1])
        if not self.spaced:
            begin[1:-1] |= space[:-1] & ~space[1:]
        edges = np.flatnonzero(begin)
        starts, stops = edges[:-1], edges[1:]
        if not self.spaced:
            kept = ~space[starts]
            starts, stops = starts[kept], stops[kept]
        return starts, stops

    def _numbers(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Number of each word in the memory, which has room for them; new ones are learnt."""
        raw = data.tobytes()
        if self.lowers and b"<|" not in raw:
            data = _FOLD[data]
        key = word_hashes(data, starts, stops, 0)
        check = (word_hashes(data, starts, stops, 1) >> np.uint64(32)).astype(np.uint32)
        number = self.memo.find(key, check)
        new = np.flatnonzero(number < 0)
        if len(new):
            both = np.stack([key[new], check[new].astype(np.uint64)], 1).view([("k", np.uint64), ("c", np.uint64)])[:, 0]
            _, one = np.unique(both, return_index=True)
            one = new[one]
            if self.memo.count + len(one) > MEMO_WORDS:
                self.memo.clear()
                _, one = np.unique(np.stack([key, check.astype(np.uint64)], 1).view([("k", np.uint64), ("c", np.uint64)])[:, 0], return_index=True)
                new = np.arange(len(key))
            words = [raw[a:b].decode() for a, b in zip(starts[one].tolist(), stops[one].tolist(), strict=True)]
            for at in range(0, len(words), 20_000):
                part = slice(at, at + 20_000)
                self.memo.add(key[one[part]], check[one[part]], self.library(words[part]))
            number[new] = self.memo.find(key[new], check[new])
        return number

    def _wide(self, data: np.ndarray) -> np.ndarray:
        """Places of white space that continues a run which does not part as two runs would."""
        if len(data) < 2:
            return np.zeros(0, np.int64)
        space = _SPACE[data] | (data == 11) | (data == 12) | ((data >= 28) & (data <= 31))
        odd = (data[1:] == 32) & space[:-1]
        high = np.flatnonzero(space[1:] & (data[:-1] >= 0x80)) + 1
        last, before = data[high - 1], data[np.maximum(high - 2, 0)]
        lead = data[np.maximum(high - 3, 0)]
        two = (before == 0xC2) & ((last == 0x85) | (last == 0xA0))
        three = np.isin(lead, (0xE1, 0xE2, 0xE3)) & np.isin(before, (0x9A, 0x80, 0x81)) & ((last <= 0x8A) | np.isin(last, (0x9F, 0xA8, 0xA9, 0xAF)))
        other = np.flatnonzero((space[1:] & space[:-1]) & ((data[:-1] == 11) | (data[:-1] == 12) | ((data[:-1] >= 28) & (data[:-1] <= 31)))) + 1
        return np.concatenate([np.flatnonzero(odd) + 1, high[two | three], other])

    def encode_buffer(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts data[ends[i]:ends[i + 1]] one after another, and their n + 1 offsets."""
        whole = np.zeros(len(ends) - 1, bool)
        if self.spaced:
            whole[np.searchsorted(ends, self._wide(data), "right") - 1] = True
        ids, counts = [], np.zeros(len(ends) - 1, np.int64)
        i = 0
        while i < len(counts):
            if whole[i] or ends[i + 1] - ends[i] > BLOCK // 2:
                ids.append(self._long(data[ends[i] : ends[i + 1]], whole[i]))
                counts[i] = len(ids[-1])
                i += 1
                continue
            stop = i
            while stop < len(counts) and not whole[stop] and ends[stop + 1] - ends[i] <= BLOCK // 2:
                stop += 1
            own, block = ends[i : stop + 1] - ends[i], data[ends[i] : ends[stop]]
            starts, stops = self._words(block, own)
            got, n = self.memo.join(self._numbers(block, starts, stops)) if len(starts) else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
            ids.append(got)
            total = np.concatenate([[0], np.cumsum(n)])
            counts[i:stop] = np.diff(total[np.searchsorted(starts, own, "left")])
            i = stop
        return (np.concatenate(ids) if ids else np.zeros(0, np.uint32)).astype("<u4", copy=False), np.concatenate([[0], np.cumsum(counts)])

    def _long(self, text: np.ndarray, whole: bool) -> np.ndarray:
        """Ids of one text that is too long for a block, or that must be encoded whole."""
        if whole or len(text) <= BLOCK // 2:
            return np.array(self.library([text.tobytes().decode()])[0], np.uint32)
        starts, stops = self._words(text, np.array([0, len(text)]))
        out, k = [np.zeros(0, np.uint32)], 0
        while k < len(starts):
            j = max(k + 1, int(np.searchsorted(stops, starts[k] + BLOCK // 2, "right")))
            if stops[j - 1] - starts[k] > BLOCK // 2:  # one word
                out.append(np.array(self.library([text[starts[k] : stops[j - 1]].tobytes().decode()])[0], np.uint32))
            else:
                block = text[starts[k] : stops[j - 1]]
                out.append(self.memo.join(self._numbers(block, starts[k:j] - starts[k], stops[k:j] - starts[k]))[0])
            k = j
        return np.concatenate(out)

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of UTF-8 texts."""
        ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
        ids, at = self.encode_buffer(np.frombuffer(b"".join(texts), np.uint8), ends)
        return cut_ids(ids, at)

    def decode(self, ids: bytes) -> str:
        return self.tokenizer.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)


def cut_ids(ids: np.ndarray, at: np.ndarray) -> list[bytes]:
    raw, at = ids.tobytes(), (4 * at).tolist()
    return [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary."""
    return Encoder(path)

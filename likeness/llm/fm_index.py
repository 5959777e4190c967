"""The FM-index of one shard of texts, over whole words, in NumPy.

A shard is its documents' words in a row, each document followed by a separator. The index
keeps the words that precede the sorted suffixes as a wavelet tree (one bit vector a level,
the nodes of a level side by side), the first place of every word among the suffixes, and
the text position of every suffix that begins at a multiple of RATE words of its document. A phrase
is searched backwards, word by word; a found suffix is walked back to a sampled one. All
phrases advance together, and so do all found suffixes.
"""

from __future__ import annotations

import numpy as np

RATE = 16
FIRST = 1  # symbol of the first word; 0 is the separator


def suffix_array(words: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``words``, whose separators all differ, by prefix doubling of what is still tied."""
    n = len(words)
    bits = max(1, int(words.max()).bit_length())
    depth = max(1, 62 // bits)
    key, ahead = np.zeros(n, np.int64), np.concatenate([words.astype(np.int64), np.zeros(depth, np.int64)])
    for j in range(depth):
        key = (key << bits) | ahead[j:j + n]
    order = np.argsort(key)
    slots, rank, tied = np.arange(n), np.zeros(n, np.int64), key[order]
    while True:
        first = np.append(True, tied[1:] != tied[:-1])
        starts = np.flatnonzero(first)
        suffixes = order[slots]
        rank[suffixes] = slots[starts][np.cumsum(first) - 1]
        slots = slots[np.repeat(np.diff(np.append(starts, len(slots))) > 1, np.diff(np.append(starts, len(slots))))]
        if not len(slots):
            return order
        suffixes = order[slots]
        tied = rank[suffixes] * n + rank[suffixes + depth]
        by = np.argsort(tied)
        order[slots], tied = suffixes[by], tied[by]
        depth *= 2


class Bits:
    """Bit vectors of equal length with ranks: ``ones(row, k)`` are the set bits before place k."""

    def __init__(self, packed: np.ndarray):
        self.packed = packed
        self.before = np.zeros(packed.shape, np.int64)
        np.cumsum(np.bitwise_count(packed[:, :-1]), axis=1, out=self.before[:, 1:])

    @staticmethod
    def pack(rows: list[np.ndarray], n: int) -> np.ndarray:
        out = np.zeros((len(rows), n // 64 + 1), np.uint64)
        for k, row in enumerate(rows):
            body = np.packbits(row, bitorder="little")
            out[k].view(np.uint8)[:len(body)] = body
        return out

    def ones(self, row: int, k: np.ndarray) -> np.ndarray:
        word, low = k >> 6, (k & 63).astype(np.uint64)
        return self.before[row, word] + np.bitwise_count(self.packed[row, word] & ((np.uint64(1) << low) - np.uint64(1)))

    def get(self, row: int, k: np.ndarray) -> np.ndarray:
        return (self.packed[row, k >> 6] >> (k & 63).astype(np.uint64)) & np.uint64(1) > 0


class FmIndex:
    """``first``: place of the first suffix of every symbol; ``tree``, ``marks``: packed bits; ``samples``: positions."""

    def __init__(self, n: int, first: np.ndarray, tree: np.ndarray, marks: np.ndarray, samples: np.ndarray):
        self.n, self.first, self.samples = n, first, samples
        self.levels = len(tree)
        self.tree, self.marks = Bits(tree), Bits(marks)
        # the node a symbol is in at a level begins where the smallest symbol of that node would
        self.begin = np.concatenate([first, np.full((1 << self.levels) + 1 - len(first), n, np.int64)])

    @staticmethod
    def build(codes: np.ndarray, limits: np.ndarray) -> tuple:
        """The parts of an index of documents with the word codes ``codes`` (from 0), parted at ``limits``."""
        docs, n = len(limits) - 1, len(codes) + len(limits) - 1
        size = np.diff(limits)
        starts = limits[:-1] + np.arange(docs)
        text = np.insert(codes.astype(np.int64) + FIRST, limits[1:], 0)
        ends = starts + size
        sortable = text + docs - 1
        sortable[ends] = np.arange(docs)
        order = suffix_array(sortable)
        before = text[order - 1]
        first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=FIRST + 1))))
        levels = max(1, int(len(first) - 2).bit_length())
        rows, symbols = [], before
        for level in range(levels):
            rows.append((symbols >> (levels - 1 - level)) & 1 > 0)
            if level < levels - 1:
                node = symbols >> (levels - 1 - level)
                node = node.astype(np.uint16) if level < 16 else node
                symbols = symbols[np.argsort(node, kind="stable")]
        sampled = (np.arange(n) - np.repeat(starts, size + 1)) % RATE == 0
        marked = sampled[order]
        return n, first, Bits.pack(rows, n), Bits.pack([marked], n), order[marked].astype(np.int32)

    def rank(self, symbol: np.ndarray, k: np.ndarray) -> np.ndarray:
        """How often each symbol stands among the first k of the sorted suffixes' preceding words."""
        for level in range(self.levels):
            rest = self.levels - level
            start = self.begin[(symbol >> rest) << rest]
            ones = self.tree.ones(level, start + k) - self.tree.ones(level, start)
            k = np.where((symbol >> (rest - 1)) & 1 > 0, ones, k - ones)
        return k

    def back(self, place: np.ndarray) -> np.ndarray:
        """The places of the suffixes one word longer."""
        k, symbol = place, np.zeros(len(place), np.int64)
        for level in range(self.levels):
            start = self.begin[symbol << (self.levels - level)]
            bit = self.tree.get(level, start + k)
            ones = self.tree.ones(level, start + k) - self.tree.ones(level, start)
            k, symbol = np.where(bit, ones, k - ones), symbol * 2 + bit
        return self.first[symbol] + k

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, first place, last place) of the phrases that occur. A row of ``phrases`` holds
        ``lengths`` symbols, from its first column on."""
        which = np.arange(len(phrases))
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for step in range(1, phrases.shape[1] + 1 if len(phrases) else 1):
            going = lengths[which] >= step
            at = np.flatnonzero(going)
            symbol = phrases[which[at], lengths[which[at]] - step]
            low[at] = self.first[symbol] + self.rank(symbol, low[at])
            high[at] = self.first[symbol] + self.rank(symbol, high[at])
            found = low < high
            which, low, high = which[found], low[found], high[found]
        return which, low, high

    def locate(self, place: np.ndarray) -> np.ndarray:
        """Text positions of the suffixes at the given places."""
        out = np.zeros(len(place), np.int64)
        left, steps = np.arange(len(place)), 0
        while len(left):
            sampled = self.marks.get(0, place)
            out[left[sampled]] = self.samples[self.marks.ones(0, place[sampled])] + steps
            left, place = left[~sampled], self.back(place[~sampled])
            steps += 1
        return out

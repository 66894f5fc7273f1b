"""A compressed FM-index over sequences of integers, searched for many sequences at once.

The index holds the Burrows-Wheeler transform as a wavelet matrix of packed bits with counts per 64
of them, and for the suffixes in their order how many symbols each shares with the one before, up
to `depth`. Backward search extends matches to the left by one symbol; if nothing matches, the match
is shortened from the right until it can be extended. So each position's matching statistic, the
length of the longest match that starts there (up to depth), takes one step and the shortenings.
"""

from __future__ import annotations

import numpy as np


def ranks_of(keys: np.ndarray) -> np.ndarray:
    """For each key the number of distinct smaller ones."""
    order = np.argsort(keys)
    new = np.empty(len(keys), np.int64)
    ordered = keys[order]
    new[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
    return new


def suffix_order(text: np.ndarray) -> np.ndarray:
    """The suffixes of a text that ends with 0, in order; each 0 ends a sequence and counts as a symbol of its own, below all others."""
    ends = text == 0
    ranks = np.where(ends, np.cumsum(ends) - 1, text + int(ends.sum()))
    ranks = ranks_of(ranks)
    together = 3 if len(text) < 1 << 21 else 2  # ranks that fit one 64-bit key
    bits, step = 63 // together, 1
    while ranks.max() < len(text) - 1:
        key = ranks.copy()
        for k in range(1, together):
            key <<= bits
            if k * step < len(text):
                key[: -k * step] += ranks[k * step :]
        ranks, step = ranks_of(key), step * together
    order = np.empty(len(text), np.int64)
    order[ranks] = np.arange(len(text))
    return order


class WaveletMatrix:
    """A sequence of numbers as one row of packed bits per bit of its numbers; counts a number in any prefix."""

    def __init__(self, numbers: np.ndarray, largest: int):
        self.levels = max(1, int(largest).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        for level in reversed(range(self.levels)):
            bits = (numbers >> level & 1).astype(bool)
            packed = np.packbits(bits, bitorder="little")
            words = np.zeros(len(numbers) // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            self.words.append(words)
            self.counts.append(np.concatenate(([0], np.cumsum(np.bitwise_count(words[:-1]), dtype=np.int32))).astype(np.int32))
            self.zeros.append(len(numbers) - int(bits.sum()))
            numbers = np.concatenate((numbers[~bits], numbers[bits]))

    def place(self, number: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Where the prefix up to `end` of a number's occurrences ends in the last level's order; differences of two ends are counts."""
        one = np.uint64(1)
        for k in range(self.levels):
            at = end >> 6
            below = (one << (end & 63).astype(np.uint64)) - one
            ones = self.counts[k][at] + np.bitwise_count(self.words[k][at] & below)
            end = np.where(number >> (self.levels - 1 - k) & 1, self.zeros[k] + ones, end - ones)
        return end


class FmIndex:
    """An index of a text of symbols 1 and above, in which a 0 follows each sequence."""

    def __init__(self, text: np.ndarray, depth: int):
        text = np.asarray(text, np.int64)
        if not len(text) or text[-1]:
            raise ValueError("the text must end with 0")
        self.depth, self.size, self.symbols = depth, len(text), int(text.max())
        self.order = suffix_order(text)
        self.bwt = WaveletMatrix(text[self.order - 1], self.symbols)  # text[-1], before the first, ends a sequence as well
        every = np.arange(self.symbols + 1)
        counts = np.bincount(text, minlength=self.symbols + 1)
        self.shift = np.cumsum(counts) - counts - self.bwt.place(every, np.zeros(len(every), np.int64))
        self.shared = self._shared(text)
        self._edges: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _shared(self, text: np.ndarray) -> np.ndarray:
        """How many symbols each suffix shares with the one before it in order, up to depth."""
        padded = np.concatenate((text, np.zeros(self.depth, np.int64)))
        out = np.zeros(self.size, np.int8 if self.depth < 128 else np.int32)
        alike = np.arange(1, self.size)
        for k in range(self.depth):
            mine = padded[self.order[alike] + k]
            alike = alike[(mine == padded[self.order[alike - 1] + k]) & (mine != 0)]
            out[alike] = k + 1
        return out

    def edges(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """For each suffix in order, where the suffixes that share its first `length` symbols begin and end."""
        if length not in self._edges:
            heads = np.flatnonzero(self.shared < length) if length else np.zeros(1, np.int64)
            which = np.zeros(self.size, np.int64)
            which[heads[1:]] = 1
            which = np.cumsum(which)
            self._edges[length] = heads[which].astype(np.int32), np.append(heads[1:], self.size)[which].astype(np.int32)
        return self._edges[length]

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes that begin with a symbol and go on as those from low to high."""
        known = (symbol > 0) & (symbol <= self.symbols)
        safe = np.where(known, symbol, 0)
        low, high = self.bwt.place(safe, low) + self.shift[safe], self.bwt.place(safe, high) + self.shift[safe]
        return np.where(known, low, 0), np.where(known, high, 0)

    def matching_statistics(self, streams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(length, low) for each position of a text of symbols, in which a 0 follows each sequence.

        length is the longest match (up to depth) of what starts there with anything in the index,
        low the first suffix, in order, that begins with it. All sequences are searched in step.
        """
        streams = np.asarray(streams, np.int64)
        stops = np.flatnonzero(streams == 0)
        sizes = np.diff(stops, prepend=-1) - 1
        longest = np.argsort(-sizes, kind="stable")
        last, sizes = stops[longest] - 1, sizes[longest]
        lengths, lows = np.zeros(len(streams), np.int32), np.zeros(len(streams), np.int32)
        low, high, length = np.zeros(len(last), np.int64), np.full(len(last), self.size), np.zeros(len(last), np.int64)
        for t in range(int(sizes[0]) if len(sizes) else 0):
            m = int(np.searchsorted(-sizes, -t, side="left"))  # sequences with more than t symbols
            at = last[:m] - t
            symbol = streams[at]
            below, above = self.extend(symbol, low[:m], high[:m])
            failed = np.flatnonzero(below >= above)
            while len(failed):
                failed = failed[length[failed] > 0]
                for short in np.unique(length[failed]) - 1:
                    rows = failed[length[failed] == short + 1]
                    begin, end = self.edges(int(short))
                    first = low[rows]
                    low[rows], high[rows], length[rows] = begin[first], end[first], short
                below[failed], above[failed] = self.extend(symbol[failed], low[failed], high[failed])
                failed = failed[below[failed] >= above[failed]]
            found = below < above
            low[:m], high[:m] = np.where(found, below, 0), np.where(found, above, self.size)
            length[:m] = np.where(found, length[:m] + 1, 0)
            over = np.flatnonzero(length[:m] > self.depth)
            if len(over):
                begin, end = self.edges(self.depth)
                first = low[over]
                low[over], high[over], length[over] = begin[first], end[first], self.depth
            lengths[at], lows[at] = length[:m], low[:m]
        return lengths, lows

"""FM-index of word sequences: bit planes with rank, backward search."""

from __future__ import annotations

import numpy as np


class BitRank:
    """A bit vector packed into 64-bit words, with the ones before each word."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int32)
        self.before = np.cumsum(ones, dtype=np.int32) - ones
        self.zeros = len(bits) - int(ones.sum())

    def rank1(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletTree:
    """Rank of any symbol in a sequence, one packed bit plane per bit of a symbol."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        self.bits = bits
        self.planes: list[BitRank] = []
        for bit in range(bits - 1, -1, -1):
            ones = (symbols >> bit) & 1
            self.planes.append(BitRank(ones))
            symbols = np.concatenate([symbols[ones == 0], symbols[ones == 1]])

    def descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where a position ends up on the lowest level if it follows the symbol's bits."""
        for plane, bit in zip(self.planes, range(self.bits - 1, -1, -1), strict=True):
            ones = plane.rank1(at)
            at = np.where((symbols >> bit) & 1, plane.zeros + ones, at - ones)
        return at


def prefix_ranks(text: np.ndarray, words: int) -> list[np.ndarray]:
    """Ranks of all positions by their first 1, 2, 4, ... symbols, up to ``words`` at least."""
    ranks = [np.unique(text, return_inverse=True)[1].astype(np.int64)]
    width = 1
    while width < words:
        rank = ranks[-1]
        after = np.zeros_like(rank)
        after[: len(rank) - width] = rank[width:] + 1
        ranks.append(np.unique(rank * (int(rank.max()) + 2) + after, return_inverse=True)[1].astype(np.int64))
        width *= 2
    return ranks


class FmIndex:
    """Index of segments of word numbers (from 1 on), each with a weight.

    Suffixes are sorted by their first 64 words, which suffices for patterns of
    fewer.  ``seed_words`` long patterns are looked up in a table of intervals;
    longer ones are extended from there, word by word, by backward search.
    """

    def __init__(self, segments: list[np.ndarray], weights: np.ndarray, longest: int) -> None:
        sizes = np.array([len(s) + 1 for s in segments])
        self.starts = np.cumsum(sizes) - sizes
        gap = np.zeros(1, dtype=np.int64)
        self.text = np.concatenate([x for s in segments for x in (s, gap)])
        ranks = prefix_ranks(self.text, longest + 1)
        # The widest power of two below the longest pattern, and its intervals.
        seed = len(bin(longest - 1)) - 3
        self.seed_words = 1 << seed
        order = np.argsort(ranks[-1], kind="stable")
        seeds = ranks[seed][order]
        bounds = np.flatnonzero(np.r_[True, seeds[1:] != seeds[:-1], True])
        self.seed_of, self.bounds = ranks[seed], bounds
        last = self.text[order - 1]  # the word before each suffix, by wrapping round
        bits = max(1, int(self.text.max()).bit_length())
        self.tree = WaveletTree(last, bits)
        symbols = np.arange(int(self.text.max()) + 1)
        self.first = np.searchsorted(self.text[order], symbols)  # where each word's suffixes begin
        self.base = self.tree.descend(symbols, np.zeros_like(symbols))
        self.weight = np.r_[0, np.cumsum(np.repeat(weights, sizes)[order])]

    def _step(self, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.first[word] + self.tree.descend(word, at) - self.base[word]

    def matching_statistics(self, ends: np.ndarray, longest: int, least: int) -> np.ndarray:
        """Per end position, how many words before it occur with a weight of ``least``.

        Counted up to ``longest``, 0 if even the seed occurs too rarely.  Every
        end must have ``longest`` words of its own segment before it.
        """
        length = np.zeros(len(ends), dtype=np.int64)
        seed = self.seed_of[ends - self.seed_words]
        low, high = self.bounds[seed], self.bounds[seed + 1]
        live = np.flatnonzero(self.weight[high] - self.weight[low] >= least)
        low, high = low[live], high[live]
        length[live] = self.seed_words
        for reach in range(self.seed_words + 1, longest + 1):
            word = self.text[ends[live] - reach]
            low, high = self._step(word, low), self._step(word, high)
            enough = self.weight[high] - self.weight[low] >= least
            live, low, high = live[enough], low[enough], high[enough]
            length[live] = reach
        return length

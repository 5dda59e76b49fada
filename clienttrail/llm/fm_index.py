"""A compressed FM-index over integer sequences, searched for many sequences at once with numpy."""

from __future__ import annotations

import numpy as np


class RankBits:
    """A bit vector in words of 64 bits with a count before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words).astype(np.int32)
        self.before = np.concatenate([[0], np.cumsum(counts[:-1], dtype=np.int32)]).astype(np.int32)
        self.zeros = int(len(bits) - counts.sum())

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit vector per bit of the alphabet."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels: list[tuple[int, RankBits]] = []
        for shift in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            bits = (sequence >> shift) & 1
            self.levels.append((shift, RankBits(bits)))
            sequence = np.concatenate([sequence[bits == 0], sequence[bits == 1]])
        self.base = np.zeros(symbols, np.int64)
        self.base = self._place(np.arange(symbols), np.zeros(symbols, np.int64))

    def _place(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits in self.levels:
            ones = bits.ones(at)
            at = np.where((symbol >> shift) & 1, bits.zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        return self._place(symbol, at) - self.base[symbol]


class FmIndex:
    """Index of weighted sequences that finds occurrences of up to `longest` consecutive symbols.

    Suffixes are ordered by their first symbols only, as many as patterns can have and one more, which
    is all that backward search of such patterns needs.
    """

    def __init__(self, sequences: list[np.ndarray], weights: np.ndarray, longest: int):
        self.longest = longest
        ends = np.cumsum([len(s) + 1 for s in sequences])
        self.starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        words = np.concatenate(sequences)
        names, ids = np.unique(words, return_inverse=True)
        text = np.zeros(int(ends[-1]), np.int64)
        is_word = np.ones(len(text), bool)
        is_word[ends - 1] = False  # each sequence ends with the symbol 0
        text[is_word] = ids + 1
        self.text = text
        order, same = self._sorted_suffixes(text, longest)
        symbols = len(names) + 1
        self.matrix = WaveletMatrix(text[order - 1], symbols)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))[:-1]])
        owner = np.searchsorted(ends, order, side="right")
        self.weight_before = np.concatenate([[0], np.cumsum(weights[owner] * is_word[order])])
        # For each suffix, the run of suffixes that agree with it in longest - 1 symbols.
        borders = np.flatnonzero(~same)
        run = np.cumsum(~same) - 1
        self.run_start = borders[run]
        self.run_end = np.append(borders[1:], len(order))[run]

    @staticmethod
    def _sorted_suffixes(text: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes by their first 2^k > longest symbols, and which agree with the one before in longest - 1."""
        n = len(text)
        rank, depth = text, 1
        same = None
        while True:
            ahead = np.zeros(n, np.int64)
            ahead[: max(0, n - depth)] = rank[depth:] + 1
            key = rank * (n + 2) + ahead
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            change = np.concatenate([[True], ordered[1:] != ordered[:-1]])
            if 2 * depth >= longest - 1 and same is None:
                # The first depth symbols and the last depth of longest - 1 cover them all.
                def shared(order: np.ndarray, rank=rank, depth=depth) -> np.ndarray:
                    late = np.minimum(order + max(0, longest - 1 - depth), n - 1)
                    head, tail = rank[order], rank[late]
                    return np.concatenate(
                        [[False], (head[1:] == head[:-1]) & (tail[1:] == tail[:-1])]
                    )

                same = shared
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(change) - 1
            depth *= 2
            if depth > longest:
                return order, same(order)

    def matching_statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """Stream all indexed sequences backwards through the index, in step.

        For each position of the text: the length of the longest match that starts there (at most
        `longest`, and not beyond its sequence) and the weight of all its occurrences.
        """
        n = len(self.text)
        length, weight = np.zeros(n, np.int64), np.zeros(n, np.int64)
        sizes = np.diff(np.append(self.starts, n)) - 1
        by_size = np.argsort(-sizes, kind="stable")
        at = (self.starts + sizes)[by_size]  # the end symbol of each
        sizes = sizes[by_size]
        low = np.zeros(len(at), np.int64)
        high = np.full(len(at), n, np.int64)
        for step in range(1, int(sizes.max(initial=0)) + 1):
            active = int(np.searchsorted(-sizes, -step, side="right"))
            low, high, at = low[:active], high[:active], at[:active] - 1
            if step > self.longest:
                # Give up the last symbol of the match: widen to all that share the others.
                low, high = self.run_start[low], self.run_end[low]
            symbol = self.text[at]
            low = self.first[symbol] + self.matrix.rank(symbol, low)
            high = self.first[symbol] + self.matrix.rank(symbol, high)
            length[at] = min(step, self.longest)
            weight[at] = self.weight_before[high] - self.weight_before[low]
        return length, weight

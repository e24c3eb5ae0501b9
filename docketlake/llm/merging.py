"""Byte-pair merging of one word with a heap of pairs and a linked list of symbols."""

from __future__ import annotations

from collections.abc import Iterable
from heapq import heapify, heappop, heappush


class Merges:
    """A merge list over numbered symbols: the initial ones first, then what merges make.

    ``numbers`` gives the number of each symbol, ``sizes`` the initial symbols it stands for.
    """

    def __init__(self, initial: Iterable[str], merges: Iterable[tuple[str, str]]):
        self.numbers = {s: i for i, s in enumerate(initial)}
        self.sizes = [1] * len(self.numbers)
        self._rank: dict[int, int] = {}         # pair of numbers -> rank, from 1
        self._made = [0]                        # rank -> number of the merged symbol
        for u, v in merges:
            a, b, made = self.numbers[u], self.numbers[v], self.numbers.setdefault(u + v, len(self.numbers))
            if made == len(self.sizes):
                self.sizes.append(self.sizes[a] + self.sizes[b])
            self._rank[a << 20 | b] = len(self._made)
            self._made.append(made)

    def merge(self, symbols: list[int]) -> int:
        """Merge in place until no ranked pair is left; returns how many merges were made.

        Always the pair of lowest rank, the leftmost among equals. A heap entry is a rank
        above a position; it is stale where the pair at the position has another rank by
        now. A symbol merged into its left neighbour becomes -1.
        """
        n, rank, made = len(symbols), self._rank.get, self._made
        shift = n.bit_length()
        low = (1 << shift) - 1
        now = [rank(a << 20 | b) for a, b in zip(symbols, symbols[1:])]
        heap = [r << shift | i for i, r in enumerate(now) if r]
        if not heap:
            return 0
        heapify(heap)
        now.append(None)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        count = 0
        while heap:
            entry = heappop(heap)
            i = entry & low
            r = entry >> shift
            if now[i] != r:
                continue
            count += 1
            j = after[i]
            symbols[i] = s = made[r]
            symbols[j] = -1
            now[j] = None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                now[i] = r = rank(s << 20 | symbols[k])
                if r:
                    heappush(heap, r << shift | i)
            else:
                now[i] = None
            if i:
                h = before[i]
                now[h] = r = rank(symbols[h] << 20 | s)
                if r:
                    heappush(heap, r << shift | h)
        return count

"""A run-compressed Burrows-Wheeler index over short strings: sampled run ends, and matching statistics streamed from them."""

from __future__ import annotations

import numpy as np

#: Symbols: 0 ends a string, 1 to 256 are bytes, MARK stands for what follows a string's anchor.
MARK = 257
#: Symbols that the first ranks compare, nine bits each.
FIRST = 7


def _ranks(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys)
    ordered = keys[order]
    ranks = np.empty(len(keys), dtype=np.int64)
    ranks[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
    return ranks


class RunIndex:
    """The strings, each parted at its anchor, sorted by suffix; what is kept are the runs of the transform.

    A string's part from its anchor on is one symbol of the text, its rank among the sorted distinct parts; so the many
    strings that go on alike after the same anchor cost no more than what stands before it. Of each run of equal letters in
    the Burrows-Wheeler transform the first and the last suffix are sampled, with the length of the match with the neighbour
    outside the run. Inside a run the letter before a suffix is also the letter before its neighbour, so a match shortens by
    one from a text position to the next: the matching statistics of every other position follow from the last sample in
    front of it. In repetitive strings runs are few and long.
    """

    def __init__(self, strings: list[bytes], anchors: list[int]):
        m = len(strings)
        lengths = np.array(anchors) + 2
        self.starts = np.cumsum(lengths) - lengths
        n = int(lengths.sum())
        self.symbols = np.zeros(n, dtype=np.uint16)
        self.of = np.repeat(np.arange(m), lengths)
        heads = b"".join(s[:a] + b"\0\0" for s, a in zip(strings, anchors, strict=True))
        self.symbols[:] = np.frombuffer(heads, dtype=np.uint8).astype(np.uint16) + 1
        self.symbols[self.starts + lengths - 1], self.symbols[self.starts + lengths - 2] = 0, MARK
        self.left = (self.starts + lengths - 1)[self.of] - np.arange(n)  # symbols before the string's end
        tails = [s[a:] for s, a in zip(strings, anchors, strict=True)]
        self.tail_lengths = np.array([len(t) for t in tails])
        width = max(1, int(self.tail_lengths.max()))
        self.tails = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in tails), dtype=np.uint8).reshape(m, width)
        place = {t: i for i, t in enumerate(sorted(set(tails)))}
        self.tail_ranks = np.array([place[t] for t in tails], dtype=np.int64)
        self.levels = self._sort(int(lengths.max()))
        self._sample()

    def _sort(self, longest: int) -> list[tuple[int, np.ndarray]]:
        """Ranks of all suffixes by their first FIRST, twice FIRST, ... symbols."""
        n = len(self.symbols)
        padded = np.concatenate([self.symbols, np.zeros(FIRST, dtype=np.uint16)]).astype(np.int64)
        keys = np.zeros(n, dtype=np.int64)
        for j in range(FIRST):
            keys = keys << 9 | np.where(self.left >= j, padded[j : j + n], 0)
        near = (self.left >= 1) & (self.left <= FIRST)  # the mark is among them: its rank decides
        ranks = _ranks(_ranks(keys) * (len(self.starts) + 1) + np.where(near, self.tail_ranks[self.of] + 1, 0))
        depth, levels = FIRST, [(FIRST, ranks)]
        while depth < longest and ranks.max() < n - 1:
            behind = np.zeros(n, dtype=np.int64)
            inside = np.flatnonzero(self.left >= depth)
            behind[inside] = ranks[inside + depth] + 1
            ranks = _ranks(ranks * (n + 1) + behind)
            depth *= 2
            levels.append((depth, ranks))
        return levels

    def _match(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The lengths to which suffixes agree, by the ranks from the longest down, then symbol by symbol, then along the parts after the anchors."""
        most = np.minimum(self.left[a], self.left[b])
        length = np.zeros(len(a), dtype=np.int64)
        for depth, ranks in reversed(self.levels):
            open_ = length <= most
            same = open_ & (ranks[np.where(open_, a + length, a)] == ranks[np.where(open_, b + length, b)])
            length += depth * same
        for _ in range(FIRST - 1):
            open_ = length < most
            x, y = np.where(open_, a + length, a), np.where(open_, b + length, b)
            same = (self.symbols[x] == self.symbols[y]) & (self.symbols[x] != MARK)
            length += open_ & same
        length = np.minimum(length, most)
        # suffixes that agree up to both marks, or past them, go on along the parts they stand for
        both = (length >= most - 1) & (self.left[a] == self.left[b]) & (self.left[a] > 0)
        i, j, at = self.of[a[both]], self.of[b[both]], self.left[a[both]] - 1
        more = np.zeros(len(i), dtype=np.int64)
        for k in range(0, len(i), 20_000):
            p, q = i[k : k + 20_000], j[k : k + 20_000]
            differ = self.tails[p] != self.tails[q]
            more[k : k + 20_000] = np.where(differ.any(axis=1), differ.argmax(axis=1), differ.shape[1])
        length[both] = at + np.minimum(more, np.minimum(self.tail_lengths[i], self.tail_lengths[j]))
        length[(self.left[a] == 0) | (self.left[b] == 0)] = 0
        return length

    def _sample(self) -> None:
        n = len(self.symbols)
        order = np.argsort(self.levels[-1][1], kind="stable")
        before = self.symbols[order - 1].astype(np.int64)
        first = np.zeros(n, dtype=bool)
        first[self.starts] = True
        before[first[order]] = -1 - order[first[order]]  # each string is preceded by an end of its own
        heads = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
        above, below = order[heads[1:] - 1], order[heads[1:]]
        match = self._match(above, below)
        self.run_heads = (np.concatenate([order[:1], below]), np.concatenate([[0], match]))
        self.run_tails = (np.concatenate([above, order[-1:]]), np.concatenate([match, [0]]))

    def statistics(self) -> np.ndarray:
        """For every text position the length in bytes of the longest match that starts there and in another string at the same place to its anchor, or ends before both anchors."""
        n, at = len(self.symbols), np.arange(len(self.symbols))
        best = np.zeros(n, dtype=np.int64)
        for positions, match in (self.run_heads, self.run_tails):
            sampled, last = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
            sampled[positions], last[positions] = match, positions
            last = np.maximum.accumulate(last)
            best = np.maximum(best, sampled[last] - (at - last))
        return best


def repeated_spans(strings: list[bytes], anchors: list[int], length: int) -> list[list[tuple[int, int]]]:
    """For each string the merged spans of its substrings of `length` bytes that begin at or before the anchor, reach it, and that another string has at the same place to its anchor."""
    index = RunIndex(strings, anchors)
    long = index.statistics() >= length
    spans = []
    for a, at in zip(anchors, index.starts, strict=True):
        own: list[tuple[int, int]] = []
        for p in np.flatnonzero(long[at : at + a + 1]).tolist():
            if own and p <= own[-1][1]:
                own[-1] = (own[-1][0], p + length)
            else:
                own.append((p, p + length))
        spans.append(own)
    return spans

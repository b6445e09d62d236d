"""FM-index over short sequences of words, with capped matching statistics.

The sequences are concatenated with a separator after each and suffix-sorted;
the Burrows-Wheeler transform is held as a wavelet matrix.  Patterns are
searched backward, all of them side by side: one step prepends each pattern's
next word by two rank queries.  The context is kept at ``depth - 1`` words at
most; when a word cannot be prepended the context is shortened from its far
end, which widens the suffix interval to the enclosing group of the
longest-common-prefix array.  So at every position of a pattern the length of
the longest match there (capped at ``depth``) and its suffix interval are
known.

The suffix array serves the construction only.  What stays is the wavelet
matrix (one bit per place and plane, with its ranks), the count of smaller
words per word, one byte per place for the common prefixes, and one owner per
group of suffixes that share ``depth`` words.
"""

from __future__ import annotations

import numpy as np

from .wavelet import WaveletMatrix


def suffix_array(codes: np.ndarray, separators: np.ndarray) -> np.ndarray:
    """Suffixes of a text (word codes from 1, separators 0) in order; the
    separators differ from one another, the earlier the smaller, so a suffix
    is decided within its sequence.  Prefix doubling; places that are already
    settled are left out of later rounds."""
    n, k = len(codes), len(separators)
    rank = codes.astype(np.int64) + (k - 1)
    rank[separators] = np.arange(k)
    order = np.argsort(rank, kind="stable")
    step = 1
    todo = np.arange(n)  # places of ``order`` not settled yet
    first = _group_starts(rank[order])
    rank[order] = first
    while True:
        same = np.zeros(n + 1, dtype=bool)
        same[1:n] = first[1:] == first[:-1]
        todo = np.flatnonzero(same[:n] | same[1:])
        if not len(todo):
            return order
        suffix = order[todo]
        ahead = suffix + step
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
        by = np.lexsort((second, first[todo]))
        order[todo] = suffix[by]
        pair_first, pair_second = first[todo][by], second[by]
        new = np.ones(len(todo), dtype=bool)
        new[1:] = (pair_first[1:] != pair_first[:-1]) | (pair_second[1:] != pair_second[:-1])
        starts = np.maximum.accumulate(np.where(new, todo, 0))
        first[todo] = starts
        rank[order[todo]] = starts
        step *= 2


def _group_starts(sorted_values: np.ndarray) -> np.ndarray:
    new = np.ones(len(sorted_values), dtype=bool)
    new[1:] = sorted_values[1:] != sorted_values[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(sorted_values)), 0))


class FMIndex:
    """Index of sequences given as one array of hashes and their lengths; with
    ``owners`` (a value per sequence) it tells the smallest owner of a match."""

    def __init__(self, words: np.ndarray, lengths: np.ndarray, depth: int, owners: np.ndarray | None = None):
        self.depth = depth
        self.alphabet, code = np.unique(words, return_inverse=True)
        n_seq = len(lengths)
        ends = np.cumsum(lengths) + np.arange(n_seq)  # place of each separator
        text = np.zeros(len(words) + n_seq, dtype=np.int64)
        is_word = np.ones(len(text), dtype=bool)
        is_word[ends] = False
        text[is_word] = code + 1
        self.n = len(text)
        sa = suffix_array(text, ends)
        self.bwt = WaveletMatrix.build(text[sa - 1], max(1, int(len(self.alphabet)).bit_length()))
        counts = np.bincount(text, minlength=len(self.alphabet) + 1)
        self.below = np.cumsum(counts) - counts
        # common prefix of each suffix with the one before it, capped at depth
        lcp = np.zeros(self.n, dtype=np.int8)
        alive = np.arange(1, self.n)
        for k in range(depth):
            a, b = sa[alive] + k, sa[alive - 1] + k
            inside = (a < self.n) & (b < self.n)
            alive, a, b = alive[inside], a[inside], b[inside]
            alive = alive[(text[a] == text[b]) & (text[a] > 0)]
            lcp[alive] = k + 1
        self.lcp = lcp
        self._cuts: dict[int, np.ndarray] = {}
        if owners is not None:  # of each suffix, then of each group
            self.least = np.minimum.reduceat(owners[np.searchsorted(ends, sa)], self.cuts(depth)[:-1])

    def cuts(self, length: int) -> np.ndarray:
        """Where groups of suffixes sharing ``length`` words begin; then n."""
        if length not in self._cuts:
            at = np.flatnonzero(self.lcp < length)
            if not len(at) or at[0]:
                at = np.concatenate(([0], at))
            self._cuts[length] = np.append(at, self.n)
        return self._cuts[length]

    def group(self, length: int, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cuts = self.cuts(length)
        g = np.searchsorted(cuts, place, "right") - 1
        return cuts[g], cuts[g + 1]

    def codes(self, words: np.ndarray) -> np.ndarray:
        """Codes of pattern words; 0 for words the index does not hold."""
        if not len(self.alphabet):
            return np.zeros(len(words), np.int64)
        p = np.minimum(np.searchsorted(self.alphabet, words), len(self.alphabet) - 1)
        return np.where(self.alphabet[p] == words, p + 1, 0)

    def matching_statistics(self, words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every word of every pattern: length of the longest match that
        starts there (capped at depth) and its suffix interval lo, hi."""
        code = self.codes(words)
        ends = np.cumsum(lengths)
        size, lo_out, hi_out = (np.zeros(len(words), np.int64) for _ in range(3))
        by = np.argsort(-lengths, kind="stable")  # longest first: those still running are a prefix
        sorted_lengths = lengths[by]
        lo, hi = np.zeros(len(by), np.int64), np.full(len(by), self.n)
        length = np.zeros(len(by), np.int64)
        for step in range(int(sorted_lengths[0]) if len(by) else 0):
            m = int(np.searchsorted(-sorted_lengths, -step, "left"))
            at = ends[by[:m]] - 1 - step
            c = code[at]
            pending = np.flatnonzero(c > 0)
            gone = c == 0
            lo[:m][gone], hi[:m][gone], length[:m][gone] = 0, self.n, 0
            while len(pending):
                a, b = self.bwt._narrow(c[pending], lo[pending], hi[pending])
                base = self._leaf(c[pending])
                a, b = a - base, b - base
                ok = b > a
                done = pending[ok]
                first = self.below[c[done]]
                lo[done], hi[done] = first + a[ok], first + b[ok]
                length[done] += 1
                pending = pending[~ok]
                shorter = length[pending] - 1
                for l in np.unique(shorter):
                    p = pending[shorter == l]
                    if l <= 0:
                        lo[p], hi[p] = 0, self.n
                    else:
                        lo[p], hi[p] = self.group(int(l), lo[p])
                length[pending] = np.maximum(shorter, 0)
            size[at], lo_out[at], hi_out[at] = length[:m], lo[:m], hi[:m]
            full = np.flatnonzero(length[:m] == self.depth)
            if len(full):
                lo[full], hi[full] = self.group(self.depth - 1, lo[full])
                length[full] = self.depth - 1
        return size, lo_out, hi_out

    def _leaf(self, code: np.ndarray) -> np.ndarray:
        """Where a code's run begins below the last plane."""
        if not hasattr(self, "_leaves"):
            every = np.arange(len(self.below))
            self._leaves = self.bwt._narrow(every, np.zeros(len(every), np.int64), np.zeros(len(every), np.int64))[0]
        return self._leaves[code]

    def smallest(self, lo: np.ndarray) -> np.ndarray:
        """Smallest owner over the interval of a match of full depth that
        begins at ``lo``."""
        return self.least[np.searchsorted(self.cuts(self.depth), lo, "right") - 1]

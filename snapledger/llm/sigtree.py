"""Signature trees: a join of sets by Jaccard similarity within one cluster that fits in memory."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LEAF = 8
#: Groups of up to so many sets are compared without a tree.
FEW = 32
#: Pairs that are looked at together.
PAIRS = 4096


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """A row of bits for each set, one set for each element's hash; as many as four times the median size, within bounds."""
    median = np.median([len(x) for x in sets])
    bits = int(min(1 << 13, max(1 << 8, 1 << int(np.ceil(np.log2(4 * max(1, median)))))))
    maps = np.zeros((len(sets), bits // 8), dtype=np.uint8)
    for i, x in enumerate(sets):
        row = np.zeros(bits, dtype=np.uint8)
        row[(x % np.uint64(bits)).astype(np.int64)] = 1
        maps[i] = np.packbits(row)
    return maps.view(np.uint64)


def possible(one: tuple, other: tuple, per_cent: int) -> np.ndarray:
    """Of each pair of nodes whether any set under the one may be similar enough to any under the other.

    A node is (OR of its sets' bitmaps, AND of them, least size, largest size). Each bit that all sets on one side
    have and none on the other has stands for at least one element that isn't shared, which bounds the overlap of
    any two sets from above.
    """
    either, both, low, high = one
    either2, both2, low2, high2 = other
    fine = (100 * high >= per_cent * low2) & (100 * high2 >= per_cent * low)
    at = np.flatnonzero(fine)
    only = np.bitwise_count(both[at] & ~either2[at]).sum(axis=1, dtype=np.int64)
    only2 = np.bitwise_count(both2[at] & ~either[at]).sum(axis=1, dtype=np.int64)
    # a set x under the one has at least ``only`` elements that no set y under the other has: the overlap is at
    # most |x| - only, the union at least |y| + only
    overlap = np.minimum(high[at] - only, high2[at] - only2)
    union = np.maximum(low2[at] + only, low[at] + only2)
    fine[at] = 100 * overlap >= per_cent * union
    return fine


class Tree:
    """Sets in a given order, and above them nodes of ``LEAF`` children each; levels from the sets up."""

    def __init__(self, maps: np.ndarray, sizes: np.ndarray):
        self.levels = [(maps, maps, sizes, sizes)]
        while len(self.levels[-1][2]) > 1:
            either, both, low, high = self.levels[-1]
            at = np.arange(0, len(low), LEAF)
            self.levels.append((np.bitwise_or.reduceat(either, at), np.bitwise_and.reduceat(both, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)))

    def pairs(self, label: np.ndarray, per_cent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Traverses the tree against itself: pairs of sets that it can't rule out, by many.

        Node pairs whose sets have one label all are skipped, so groups of near copies don't cost a comparison
        for each pair.
        """
        same = [(label, label)]
        for _ in self.levels[1:]:
            at = np.arange(0, len(same[-1][0]), LEAF)
            same.append((np.minimum.reduceat(same[-1][0], at), np.maximum.reduceat(same[-1][1], at)))
        stack = [(len(self.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        x, y = np.divmod(np.arange(LEAF * LEAF), LEAF)
        while stack:
            level, i, j = stack.pop()
            if len(i) > PAIRS:
                stack += [(level, i[at : at + PAIRS], j[at : at + PAIRS]) for at in range(0, len(i), PAIRS)]
                continue
            small, large = same[level]
            left = ~((small[i] == large[i]) & (small[j] == large[j]) & (small[i] == small[j]))
            i, j = i[left], j[left]
            fine = (i == j) | possible(tuple(a[i] for a in self.levels[level]), tuple(a[j] for a in self.levels[level]), per_cent)
            i, j = i[fine], j[fine]
            if level == 0:
                yield i, j
            elif len(i):
                a, b = (i[:, None] * LEAF + x).ravel(), (j[:, None] * LEAF + y).ravel()
                below = len(self.levels[level - 1][2])
                keep = (a < below) & (b < below) & (a <= b)
                stack.append((level - 1, a[keep], b[keep]))


def similar(x: np.ndarray, y: np.ndarray, per_cent: int) -> bool:
    """Exact: 100 * overlap >= per_cent * union, of sorted arrays without repeats."""
    if not len(x) or not len(y):
        return False
    at = np.searchsorted(y, x)
    overlap = int(np.count_nonzero(y[np.minimum(at, len(y) - 1)] == x))
    return 100 * overlap >= per_cent * (len(x) + len(y) - overlap)


class _Groups:
    """Sets that are linked so far, by label."""

    def __init__(self, sets: list[np.ndarray], per_cent: int):
        self.sets, self.per_cent = sets, per_cent
        self.label = np.arange(len(sets))
        self.members = {i: [i] for i in range(len(sets))}

    def join(self, i: int, j: int) -> None:
        a, b = int(self.label[i]), int(self.label[j])
        a, b = (a, b) if len(self.members[a]) >= len(self.members[b]) else (b, a)
        self.label[self.members[b]] = a
        self.members[a] += self.members.pop(b)

    def compare(self, i: np.ndarray, j: np.ndarray) -> None:
        """Compares pairs exactly, each unless a chain of links joins the two already."""
        label, sets = self.label, self.sets
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            if label[a] != label[b] and similar(sets[a], sets[b], self.per_cent):
                self.join(a, b)


def group(sets: list[np.ndarray], per_cent: int, signs: list[np.ndarray]) -> np.ndarray:
    """Of each set the number of the first one, in the order given, that it's linked with by a chain of similar sets.

    Similar sets have a signature of ``signs`` in common, so only sets that share one are compared. First each with
    the first of its group, which joins most near copies; then, in groups that are still of several components, all
    that are in different ones, and in large groups by a tree.
    """
    n = len(sets)
    maps, sizes = bitmaps(sets), np.array([len(x) for x in sets])
    leaf = lambda i: (maps[i], maps[i], sizes[i], sizes[i])
    found = _Groups(sets, per_cent)
    sign, who = np.concatenate(signs), np.repeat(np.arange(n), [len(x) for x in signs])
    order = np.lexsort((who, sign))
    sign, who = sign[order], who[order]
    begin = np.flatnonzero(np.concatenate(([True], sign[1:] != sign[:-1]))) if len(sign) else np.zeros(0, np.int64)
    size = np.diff(np.concatenate((begin, [len(sign)])))
    head = np.repeat(who[begin], size)

    def look(i: np.ndarray, j: np.ndarray) -> None:
        """Compares the distinct pairs of different components that their bitmaps don't rule out."""
        code = np.unique(i * n + j)
        for at in range(0, len(code), PAIRS):
            i, j = np.divmod(code[at : at + PAIRS], n)
            apart = found.label[i] != found.label[j]
            i, j = i[apart], j[apart]
            fine = possible(leaf(i), leaf(j), per_cent)
            found.compare(i[fine], j[fine])

    look(head, who)
    few: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0
    mixed = np.flatnonzero(np.minimum.reduceat(found.label[who], begin) != np.maximum.reduceat(found.label[who], begin)) if len(begin) else begin
    for g in mixed.tolist():
        some = who[begin[g] : begin[g] + size[g]]
        if len(some) <= FEW:
            a, b = np.triu_indices(len(some), 1)
            few.append((some[a], some[b]))
            waiting += len(a)
            if waiting > 64 * PAIRS:
                look(*(np.concatenate(x) for x in zip(*few, strict=True)))
                few, waiting = [], 0
            continue
        some = some[np.lexsort((sizes[some], found.label[some]))]
        for a, b in Tree(maps[some], sizes[some]).pairs(found.label[some], per_cent):
            found.compare(some[a], some[b])
    if few:
        look(*(np.concatenate(x) for x in zip(*few, strict=True)))
    out = np.full(n, n)
    np.minimum.at(out, found.label, np.arange(n))
    return out[found.label]

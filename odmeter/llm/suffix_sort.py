"""Deep-shallow sorting of byte strings.

A multikey quicksort splits the strings in three at a pivot, by one symbol of eight bytes after the other, down to a shallow depth;
groups that still agree are ordered by a blind trie each, which keeps only branching places and so doesn't care how long
the common prefixes are.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 16


def common_prefix(a: bytes, b: bytes) -> int:
    """Number of leading bytes in common."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def _symbol(text: bytes, at: int) -> int:
    return text[at] if at < len(text) else -1  # the end comes before any byte


class BlindTrie:
    """Branching places of some strings; a branch is [depth, {symbol: child}], a leaf the numbers of equal strings."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self.top = None
        for number in range(len(texts)):
            self._add(number)

    def _add(self, number: int) -> None:
        text = self.texts[number]
        if self.top is None:
            self.top = (number, [number])
            return
        node = self.top
        while isinstance(node, list):  # blindly to some leaf: only branching places are looked at
            branches = node[1]
            node = branches.get(_symbol(text, node[0])) or next(iter(branches.values()))
        other = self.texts[node[0]]
        depth = common_prefix(text, other)
        if depth == len(text) == len(other):
            node[1].append(number)
            return
        leaf, above, node = (number, [number]), None, self.top
        while isinstance(node, list) and node[0] < depth:
            above, node = node, node[1][_symbol(text, node[0])]
        if isinstance(node, list) and node[0] == depth:
            node[1][_symbol(text, depth)] = leaf
            return
        branch = [depth, {_symbol(other, depth): node, _symbol(text, depth): leaf}]
        if above is None:
            self.top = branch
        else:
            above[1][_symbol(text, above[0])] = branch

    def ordered(self) -> tuple[list[int], list[int]]:
        """Numbers in order of the strings, and the common prefix of each with the one before (0 for the first)."""
        order, shared = [], []
        stack = [(self.top, 0)] if self.top is not None else []
        while stack:
            node, before = stack.pop()
            if isinstance(node, list):
                depth, branches = node
                children = [branches[s] for s in sorted(branches)]
                stack += [(child, depth) for child in reversed(children[1:])]
                stack.append((children[0], before))
            else:
                length = len(self.texts[node[0]])
                for k, number in enumerate(node[1]):
                    order.append(number)
                    shared.append(length if k else before)
        return order, shared


def _pivot(keys: np.ndarray) -> int:
    """The middle one of three."""
    return sorted((int(keys[0]), int(keys[len(keys) // 2]), int(keys[-1])))[1]


def multikey_quicksort(symbols: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Order of the rows of ``symbols`` (a column per depth), and the bounds of the groups that agree in all columns, rising.

    A group is split in three at a pivot of its symbols at one depth: those below and those above stay at this depth, those
    equal to it go on to the next.
    """
    order, groups = np.arange(len(symbols)), []
    todo = [(0, len(symbols), 0)]
    while todo:
        first, last, depth = todo.pop()
        if last - first < 2 or depth == symbols.shape[1]:
            if last > first:
                groups.append((first, last))
            continue
        some = order[first:last]
        keys = symbols[some, depth]
        pivot = _pivot(keys)
        low, high = keys < pivot, keys > pivot
        below, above = some[low], some[high]
        equal = some[~(low | high)]
        order[first:last] = np.concatenate([below, equal, above])
        middle = first + len(below)
        todo += [(middle + len(equal), last, depth), (middle, middle + len(equal), depth + 1), (first, middle, depth)]
    return order, groups


def deep_shallow_sort(texts: list[bytes], shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings, and in that order the common prefix of each with the one before (0 for the first)."""
    n = len(texts)
    shared = np.zeros(n, np.int64)
    if n < 2:
        return np.arange(n), shared
    words = -(-shallow // 8)
    head = np.frombuffer(b"".join(t[: words * 8].ljust(words * 8, b"\0") for t in texts), ">u8").reshape(n, words).astype(np.uint64)
    lengths = np.array([len(t) for t in texts])
    held = np.clip(lengths[:, None] - 8 * np.arange(words), 0, 8).astype(np.uint64)  # a string that ends comes before those that go on
    order, groups = multikey_quicksort(np.stack([head, held], 2).reshape(n, 2 * words))
    for first, last in groups:
        if first:  # groups differ within the shallow depth, so any of either shows how far they agree
            shared[first] = common_prefix(texts[order[first - 1]], texts[order[first]])
        if last - first > 1:
            some = order[first:last]
            inner, depth = BlindTrie([texts[i] for i in some]).ordered()
            order[first:last] = some[inner]
            shared[first + 1 : last] = depth[1:]
    return order, shared

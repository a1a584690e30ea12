"""A HAT-trie over word ids that counts phrases: hash containers under a shallow trie, whole subtrees spilled as runs.

A phrase of up to m words is one 64-bit key, its word ids in fields from the top, 0 where there is no word. The trie's
nodes branch on the first and on the second word; a child covers a range of words and starts as a hash container. A
container that grows too large bursts: into two over half the words each, or, once it covers a single word, into a node
that branches on the next one. Below the second word containers only grow.

Batches of keys are sorted, so a batch reaches each container as one slice and is added with a few array operations.
"""

from __future__ import annotations

import numpy as np

from isoreach.llm.common import mix64

#: Phrases in a container before it bursts, and levels of the trie that branch.
BURST = 1 << 15
DEPTH = 2


class Container:
    """Open-addressing hash table from key (never 0) to count."""

    def __init__(self):
        self.keys, self.counts, self.n = np.zeros(256, np.uint64), np.zeros(256, np.int64), 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Add counts of distinct keys."""
        if (self.n + len(keys)) * 2 > len(self.keys):
            held, size = self.items(), len(self.keys)
            while (self.n + len(keys)) * 2 > size:
                size *= 2
            self.keys, self.counts, self.n = np.zeros(size, np.uint64), np.zeros(size, np.int64), 0
            self._place(*held)
        self._place(keys, counts)

    def _place(self, keys: np.ndarray, counts: np.ndarray) -> None:
        mask = np.uint64(len(self.keys) - 1)
        slots = mix64(keys) & mask
        while len(keys):
            free = self.keys[slots] == 0
            self.keys[slots[free]] = keys[free]  # where several keys want a slot, one of them gets it
            won = self.keys[slots] == keys
            self.counts[slots[won]] += counts[won]
            self.n += int((free & won).sum())
            lost = ~won
            keys, counts, slots = keys[lost], counts[lost], (slots[lost] + np.uint64(1)) & mask

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        used = np.flatnonzero(self.keys)
        return self.keys[used], self.counts[used]


class Node:
    """A branching level: children over consecutive ranges of the words at this level."""

    def __init__(self, level: int, low: np.uint64, bits: int, words: int):
        self.level, self.bits, self.words = level, bits, words
        self.starts, self.children = [np.uint64(low)], [Container()]

    @property
    def n(self) -> int:
        return sum(c.n for c in self.children)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Add counts of distinct, sorted keys."""
        cuts = [0, *np.searchsorted(keys, np.array(self.starts[1:], np.uint64)).tolist(), len(keys)]
        large = []
        for i, child in enumerate(self.children):
            if cuts[i] < cuts[i + 1]:
                child.add(keys[cuts[i] : cuts[i + 1]], counts[cuts[i] : cuts[i + 1]])
                if isinstance(child, Container) and child.n > BURST:
                    large.append(i)
        for i in reversed(large):
            self.burst(i)

    def burst(self, i: int) -> None:
        keys, counts = self.children[i].items()
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        shift = np.uint64(self.bits * (self.words - 1 - self.level))
        word = keys >> shift
        if word[0] != word[-1]:
            cut = int(np.searchsorted(word, word[len(word) // 2]))
            cut = cut or int(np.searchsorted(word, word[0], "right"))
            halves = [(keys[:cut], counts[:cut]), (keys[cut:], counts[cut:])]
            self.starts.insert(i + 1, word[cut] << shift)
            self.children[i : i + 1] = [Container(), Container()]
            for k, half in enumerate(halves):
                self.children[i + k].add(*half)
        elif self.level + 1 < min(DEPTH, self.words):
            below = Node(self.level + 1, word[0] << shift, self.bits, self.words)
            below.add(keys, counts)
            self.children[i] = below

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        parts = [c.items() for c in self.children]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


class HatTrie:
    def __init__(self, words: int):
        self.words, self.bits = words, 63 // words
        self.root = Node(0, np.uint64(0), self.bits, words)

    @property
    def n(self) -> int:
        return self.root.n

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.root.add(keys, counts)

    def take(self, leave: int) -> tuple[np.ndarray, np.ndarray]:
        """Remove whole subtrees of the root, largest first, until at most ``leave`` phrases are left; their contents."""
        sizes = [c.n for c in self.root.children]
        left, taken = sum(sizes), []
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            if left <= leave:
                break
            taken.append(self.root.children[i].items())
            self.root.children[i] = Container()
            left -= sizes[i]
        if not taken:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return np.concatenate([t[0] for t in taken]), np.concatenate([t[1] for t in taken])

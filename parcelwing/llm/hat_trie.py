"""A counting HAT-trie over word ids: hash containers below a shallow trie, spilled as sorted runs.

Keys are sequences of word numbers, four big-endian bytes each. A node starts as
one hash container. When that overflows it bursts: every first word under which
many keys lie gets a node of its own, whose keys go on without that word; the
rest stay together. Only the first levels burst. When the trie holds too many
keys, its largest subtrees leave it whole, each as one run in key order.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

WORD = 4               # bytes of a word number
BURST = 16_384         # keys in a container before it bursts
CROWD = 64             # keys below one word that make it a node
DEPTH = 2              # levels that may burst


class Node:
    """One container of keys, and the nodes below the words that burst out of it."""

    __slots__ = ("rest", "below", "depth", "burst_at")

    def __init__(self, depth: int):
        self.rest: dict[bytes, int] = {}
        self.below: dict[bytes, Node] = {}
        self.depth = depth
        self.burst_at = BURST

    def burst(self) -> None:
        """Give crowded first words nodes of their own; what stays may grow as much again."""
        crowds = Counter(key[:WORD] for key in self.rest)
        for word, keys in crowds.items():
            if keys >= CROWD and word:
                self.below[word] = Node(self.depth + 1)
        kept = {}
        for key, n in self.rest.items():
            node = self.below.get(key[:WORD])
            if node is None:
                kept[key] = n
            else:
                node.rest[key[WORD:]] = n
        self.rest = kept
        self.burst_at = 2 * len(kept) + BURST

    def size(self) -> int:
        return len(self.rest) + sum(node.size() for node in self.below.values())

    def items(self, lead: bytes = b"") -> Iterator[tuple[bytes, int]]:
        for key, n in self.rest.items():
            yield lead + key, n
        for word, node in self.below.items():
            yield from node.items(lead + word)


class HatTrie:
    def __init__(self, most: int):
        self.root = Node(0)
        self.most = most
        self.keys = 0

    def add(self, counted: Iterable[tuple[bytes, int]]) -> None:
        """Add counts of keys; keys that follow one another in key order are found fastest."""
        root, lead, home, new = self.root, None, self.root, 0
        full: set[Node] = set()
        for key, n in counted:
            if key[:WORD] != lead:
                lead = key[:WORD]
                home = root.below.get(lead, root)
            node, key = (home, key) if home is root else (home, key[WORD:])
            while node.below:
                under = node.below.get(key[:WORD])
                if under is None:
                    break
                node, key = under, key[WORD:]
            rest = node.rest
            before = rest.get(key)
            if before is None:
                rest[key] = n
                new += 1
                if len(rest) > node.burst_at and node.depth < DEPTH:
                    full.add(node)
            else:
                rest[key] = before + n
        self.keys += new
        for node in full:
            node.burst()

    def spill(self, everything: bool = False) -> Iterator[list[tuple[bytes, int]]]:
        """Sorted runs of the largest subtrees, until half the room is free again (or nothing is left)."""
        if not everything and self.keys <= self.most:
            return
        left = 0 if everything else self.most // 2
        sizes = sorted(((node.size(), word) for word, node in self.root.below.items()), reverse=True)
        for size, word in sizes:
            if self.keys <= left:
                break
            yield sorted(self.root.below.pop(word).items(word))
            self.keys -= size
        if self.keys > left and self.root.rest:
            run, self.root.rest = sorted(self.root.rest.items()), {}
            self.root.burst_at = BURST
            self.keys -= len(run)
            yield run

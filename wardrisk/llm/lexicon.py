"""Minimal acyclic transducer from words to id sequences, in one file that workers map into memory.

States with equal futures are shared, so common suffixes are stored once.  Every transition carries
the number of accepted words that come before its own; the sum along a word's path is the word's
place in sorted order, under which its ids lie.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Sequence

import numpy as np

#: Words of more bytes are left out.
LONGEST = 48


def compile_lexicon(entries: Iterable[tuple[bytes, Sequence[int]]], path: str) -> None:
    """Write the transducer of distinct words and their ids."""
    entries = sorted((w, ids) for w, ids in entries if len(w) <= LONGEST)
    words = [w for w, _ in entries]
    register: dict[tuple, int] = {}
    states: list[tuple] = []  # (accepting, ((byte, state), ...)); futures come before their pasts
    accepted: list[int] = []

    def state_of(low: int, high: int, depth: int) -> int:
        """The state that accepts the rests of words[low:high], which agree in their first ``depth`` bytes."""
        accepting = low < high and len(words[low]) == depth
        start, edges = low + accepting, []
        while start < high:
            byte, end = words[start][depth], start + 1
            while end < high and words[end][depth] == byte:
                end += 1
            edges.append((byte, state_of(start, end, depth + 1)))
            start = end
        signature = accepting, tuple(edges)
        if signature not in register:
            register[signature] = len(states)
            states.append(signature)
            accepted.append(accepting + sum(accepted[s] for _, s in edges))
        return register[signature]

    root = state_of(0, len(words), 0)
    keys, targets, weights = [], [], []
    for number, (accepting, edges) in enumerate(states):
        before = int(accepting)
        for byte, target in edges:
            keys.append(number << 8 | byte)
            targets.append(target)
            weights.append(before)
            before += accepted[target]
    bounds = np.cumsum([0] + [len(ids) for _, ids in entries])
    arrays = [np.array(keys, "<i8"), np.array(targets, "<i8"), np.array(weights, "<i8"),
              np.array([a for a, _ in states], "<i8"), bounds.astype("<i8"),
              np.array([i for _, ids in entries for i in ids], "<i8")]
    with open(path, "wb") as out:
        np.array([root] + [len(a) for a in arrays], "<i8").tofile(out)
        for array in arrays:
            array.tofile(out)


class Lexicon:
    """A compiled transducer, mapped and not read: workers of a machine share its pages."""

    def __init__(self, path: str):
        data = np.memmap(path, dtype="<i8", mode="r", shape=(os.path.getsize(path) // 8,))
        self.root, *sizes = (int(x) for x in data[:7])
        ends = 7 + np.cumsum([0] + sizes)
        self.keys, self.targets, self.weights, self.accepting, self.bounds, self.ids = (
            data[a:b] for a, b in zip(ends[:-1], ends[1:]))

    def find(self, words: Sequence[bytes]) -> list[bytes | None]:
        """The ids of each word as little-endian 32-bit numbers, or None; all words step through the states together."""
        found: list[bytes | None] = [None] * len(words)
        if not len(self.keys) or not words:
            return found
        sizes = np.array([len(w) for w in words])
        text = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        alive = np.flatnonzero((sizes <= LONGEST) & (sizes > 0))
        state = np.full(len(words), self.root)
        number = np.zeros(len(words), dtype=np.int64)
        ended = []
        for depth in range(LONGEST):
            if not len(alive):
                break
            key = state[alive] << 8 | text[starts[alive] + depth]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[edge] == key
            alive, edge = alive[known], edge[known]
            state[alive] = self.targets[edge]
            number[alive] += self.weights[edge]
            done = sizes[alive] == depth + 1
            ended.append(alive[done])
            alive = alive[~done]
        for i in np.concatenate(ended) if ended else ():
            if self.accepting[state[i]]:
                a, b = self.bounds[number[i]], self.bounds[number[i] + 1]
                found[i] = self.ids[a:b].astype("<u4").tobytes()
        return found

"""Suffix array of a byte string by two-stage sorting, and the common prefixes of its neighbours.

A suffix smaller than its successor is sorted directly, by eight bytes at a time and only as long as
it ties.  Every other suffix is induced: buckets by first byte are scanned from the smallest, and
each suffix met places the one that begins a byte earlier, if that one is larger than it.
"""

from __future__ import annotations

import numpy as np


def big_endian_words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one number, zeros beyond the end."""
    words = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    for width in (1, 2, 4):
        shifted = np.zeros_like(words)
        shifted[:-width] = words[width:]
        words = words << np.uint64(8 * width) | shifted
    return words[:len(text)]


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one a byte later; the last one is larger than the empty suffix."""
    n = len(text)
    changes = np.flatnonzero(text[1:] != text[:-1])  # the last position of each run of one byte but the last run
    rises = np.append(text[1:][changes] > text[:-1][changes], False)
    return rises[np.searchsorted(changes, np.arange(n))]


def sort_directly(starts: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` bytes at least; equal ones by position."""
    def word(at):
        inside = at < len(words)
        return np.where(inside, words[np.minimum(at, len(words) - 1)], np.uint64(0))

    order = starts[np.argsort(words[starts], kind="stable")]
    first = words[order]
    group = np.cumsum(np.append(True, first[1:] != first[:-1])) if len(order) else first
    places = np.arange(len(order))
    for done in range(8, depth, 8):
        if not len(places):
            break
        sizes = np.bincount(group)
        tied = sizes[group] > 1
        places, group = places[tied], group[tied]
        if not len(places):
            break
        following = word(order[places] + done)
        again = np.lexsort((following, group))
        order[places], following = order[places][again], following[again]  # groups stay where they are
        group = np.cumsum(np.append(True, (group[1:] != group[:-1]) | (following[1:] != following[:-1])))
    return order


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of their first ``depth`` bytes at least."""
    n = len(text)
    if not n:
        return np.empty(0, np.int64)
    rising = smaller_than_next(text)
    direct = sort_directly(np.flatnonzero(rising), big_endian_words(text), depth)
    bounds = np.searchsorted(text[direct], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[text[n - 1]].append(np.array([n - 1]))  # follows the empty suffix

    def hand_on(before: np.ndarray, byte: int) -> None:
        """Place those that begin with a larger byte at the ends of their buckets, in order."""
        bytes_ = text[before]
        larger = bytes_ > byte
        before, bytes_ = before[larger], bytes_[larger]
        by_byte = np.argsort(bytes_, kind="stable")
        before, bytes_ = before[by_byte], bytes_[by_byte]
        edges = np.flatnonzero(np.append(True, bytes_[1:] != bytes_[:-1])) if len(bytes_) else []
        for part in np.split(before, edges[1:]) if len(bytes_) else []:
            induced[text[part[0]]].append(part)

    parts = []
    for byte in range(256):
        bucket = []
        front = np.concatenate(induced[byte]) if induced[byte] else np.empty(0, np.int64)
        while len(front):  # suffixes that repeat the byte before follow in rounds
            bucket.append(front)
            before = front[front > 0] - 1
            front = before[(text[before] == byte) & ~rising[before]]
        own = direct[bounds[byte]:bounds[byte + 1]]
        bucket.append(own)
        whole = np.concatenate(bucket)
        before = whole[whole > 0] - 1
        hand_on(before, byte)
        parts.append(whole)
    return np.concatenate(parts)


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of each suffix in the order and the one before it, up to ``depth``; the first has 0."""
    lengths = np.zeros(len(order), dtype=np.int64)
    words = big_endian_words(text)
    alive = np.arange(1, len(order))
    for done in range(0, depth, 8):
        a, b = order[alive - 1] + done, order[alive] + done
        inside = (a < len(text)) & (b < len(text))
        alive, a, b = alive[inside], a[inside], b[inside]
        differ = words[a] ^ words[b]
        same = np.full(len(alive), 8)
        other = differ != 0
        # leading equal bytes of the word, from the place of its highest differing bit
        bits = np.floor(np.log2(np.maximum(differ[other] >> np.uint64(32), differ[other] & np.uint64(0xFFFFFFFF)
                                           * (differ[other] >> np.uint64(32) == 0)).astype(float)))
        high = (differ[other] >> np.uint64(32)) != 0
        same[other] = 7 - (bits + 32 * high).astype(np.int64) // 8
        lengths[alive] += np.minimum(same, len(text) - np.maximum(a, b))
        alive = alive[~other]
        if not len(alive):
            break
    return np.minimum(lengths, depth)

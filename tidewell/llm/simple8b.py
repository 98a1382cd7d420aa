"""Simple-8b: ids packed into 64-bit words, coded and decoded a whole array at a time.

A word's four high bits are its selector, the other sixty hold COUNTS[s] ids of WIDTHS[s] bits, the first in the low
bits. Selector 15 is an escape: its payload indexes the list of raw 64-bit values (ids of over 60 bits). Every BLOCK
ids the coding starts at a new word, and the offset of that word is kept, so that blocks decode by themselves.
"""

from __future__ import annotations

import numpy as np

# Fixed values of the coding: ids in a word and bits of an id, by selector.
COUNTS = np.array([240, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1])
WIDTHS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 60])
ESCAPE = 15
BLOCK = 1024


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (uint64), the index of each block's first word and the number of words (int64), escaped values (uint64)."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.uint64)
    limits = np.array([(1 << int(w)) - 1 for w in WIDTHS[:ESCAPE]], np.uint64)
    least = np.searchsorted(limits, ids).astype(np.uint8)  # the first selector wide enough, 15 for none
    at = np.arange(n, dtype=np.int32)
    ends = np.minimum((at // BLOCK + 1) * BLOCK, n).astype(np.int32)
    selector = np.where(least < ESCAPE, np.uint8(14), np.uint8(ESCAPE))
    widest, upto = int(least.max()), np.zeros(n + 1, np.int32)
    for s in range(13, -1, -1):  # what fits a selector fits the next wider one, so the places left only shrink
        if widest > s:
            np.cumsum(least > s, out=upto[1:])
            at = at[upto[np.minimum(at + np.int32(COUNTS[s]), ends[at])] == upto[at]]
        if not len(at):
            break
        selector[at] = s
    after = np.minimum(np.arange(n, dtype=np.int32) + COUNTS.astype(np.int32)[selector], ends)
    at, chosen = np.arange(0, n, BLOCK), np.zeros(n, bool)  # one step in every block at a time
    stop = ends[at]
    while len(at):
        chosen[at] = True
        at = after[at]
        go = at < stop
        at, stop = at[go], stop[go]
    begins = np.flatnonzero(chosen)
    used = selector[begins]
    words = used.astype(np.uint64) << np.uint64(60)
    padded = np.concatenate([ids, np.zeros(int(COUNTS.max()), np.uint64)])
    for s in range(1, ESCAPE):
        where = np.flatnonzero(used == s)
        if len(where):
            spots = begins[where][:, None] + np.arange(COUNTS[s])
            parts = np.where(spots < ends[begins[where]][:, None], padded[spots], np.uint64(0))
            words[where] |= np.bitwise_or.reduce(parts << (np.arange(COUNTS[s]) * WIDTHS[s]).astype(np.uint64), axis=1)
    escaped = np.flatnonzero(used == ESCAPE)
    words[escaped] |= np.arange(len(escaped), dtype=np.uint64)
    return words, np.concatenate([np.searchsorted(begins, np.arange(0, n, BLOCK)), [len(words)]]).astype(np.int64), ids[begins[escaped]]


def decode(words: np.ndarray, offsets: np.ndarray, n: int, escapes: np.ndarray, first: int = 0, blocks: int | None = None) -> np.ndarray:
    """The ids (uint64) of ``blocks`` blocks from block ``first`` on; ``n`` is the number of ids of all blocks."""
    last = len(offsets) - 1 if blocks is None else min(first + blocks, len(offsets) - 1)
    if last <= first:
        return np.zeros(0, np.uint64)
    total = min(last * BLOCK, n) - first * BLOCK
    words = words[offsets[first] : offsets[last]]
    selector = (words >> np.uint64(60)).astype(np.uint8)
    payload = words & np.uint64((1 << 60) - 1)
    counts = COUNTS[selector].astype(np.int64)
    heads = offsets[first:last] - offsets[first]
    tails = np.append(heads[1:], len(words)) - 1
    room = np.minimum(BLOCK, total - np.arange(last - first) * BLOCK)
    counts[tails] += room - np.add.reduceat(counts, heads)  # a block's last word may have room for more ids than are left
    starts = np.cumsum(counts) - counts
    out = np.zeros(total + int(COUNTS.max()), np.uint64)
    for s in range(1, ESCAPE):
        where = np.flatnonzero(selector == s)
        if len(where):
            steps = np.arange(COUNTS[s])
            values = (payload[where][:, None] >> (steps * WIDTHS[s]).astype(np.uint64)) & np.uint64((1 << int(WIDTHS[s])) - 1)
            inside = steps < counts[where][:, None]
            out[(starts[where][:, None] + steps)[inside]] = values[inside]
    where = np.flatnonzero(selector == ESCAPE)
    out[starts[where]] = escapes[payload[where].astype(np.int64)]
    return out[:total]

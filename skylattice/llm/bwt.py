"""Burrows-Wheeler transforms of collections of short symbol strings, merged by iterative interleave refinement.

Strings are rotated, each with its own end symbol 0, and ordered by their first `depth` symbols. A shard's transform is
sorted once. Merging keeps, for each place of the merged order, only the shard it comes from: it starts with the shards
one after another, and a stable counting sort of the merged transform's symbols turns an interleave that is right for
contexts of h symbols into one that is right for h + 1. Blocks of places with equal contexts split in the same step; the
step at which two neighbours part is their longest common prefix. No suffix is compared or sorted again.
"""

from __future__ import annotations

import numpy as np


class Shard:
    """symbols: uint16 strings laid end to end, each ending in 0. order: text positions by context; bwt: the symbol
    before each."""

    def __init__(self, symbols: np.ndarray, depth: int):
        n = len(symbols)
        ends = np.flatnonzero(symbols == 0)
        starts = np.append(0, ends[:-1] + 1)
        after = np.arange(1, n + 1)
        after[ends] = starts  # the next position of a rotation
        before = np.arange(-1, n - 1)
        before[starts] = ends
        rank, jump, width = symbols.astype("int64"), after, 1
        order = np.argsort(symbols, kind="stable")
        while width < depth:
            pair = rank * np.int64(max(n, 65536) + 1) + rank[jump]
            order = np.argsort(pair, kind="stable")
            new = np.empty(n, "int64")
            new[order] = np.cumsum(np.append(False, np.diff(pair[order]) != 0))
            rank, jump, width = new, jump[jump], width * 2
        self.order, self.bwt = order, symbols[before[order]]


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, position, same): by merged order, whose place it is, and whether its first `depth` symbols are those of
    the place before."""
    sizes = [len(s.bwt) for s in shards]
    n = sum(sizes)
    bwt = np.concatenate([s.bwt for s in shards])
    z = np.repeat(np.arange(len(shards), dtype="uint16" if len(shards) > 255 else "uint8"), sizes)
    block, source = np.zeros(n, "int32"), np.empty(n, "int64")
    for _ in range(depth):
        source[np.argsort(z, kind="stable")] = np.arange(n)  # each shard's places keep their order
        symbols = bwt[source]
        order = np.argsort(symbols, kind="stable")
        sorted_symbols, old = symbols[order], block[order]
        part = np.empty(n, bool)
        part[:1] = False
        part[1:] = (sorted_symbols[1:] != sorted_symbols[:-1]) | (old[1:] != old[:-1])
        block, z = np.cumsum(part, dtype="int32"), z[order]
    source[np.argsort(z, kind="stable")] = np.arange(n)
    position = np.concatenate([s.order for s in shards])[source]
    same = np.append(False, block[1:] == block[:-1]) if n else np.zeros(0, bool)
    return z, position, same


def repeated(strings: list[np.ndarray], counts: np.ndarray, depth: int, shard_symbols: int) -> list[np.ndarray]:
    """For each string (symbols from 1 up), whether the `depth` symbols from each of its offsets on occur twice or more
    in all strings, each taken `counts` times. Offsets with fewer symbols left are not asked for and left out."""
    shards, where, at, size = [], [], 0, 0
    flat_sizes = np.array([len(s) + 1 for s in strings])
    begin = 0
    zero = np.zeros(1, "uint16")
    while begin < len(strings):
        end = begin + max(1, int(np.searchsorted(np.cumsum(flat_sizes[begin:]), shard_symbols, "right")))
        symbols = np.concatenate([x for s in strings[begin:end] for x in (s, zero)])
        shards.append(Shard(symbols, depth))
        where.append(np.repeat(np.arange(begin, end), flat_sizes[begin:end]))
        begin = end
    z, position, same = merge(shards, depth)
    base = np.append(0, np.cumsum([len(w) for w in where]))[:-1]
    at = base[z] + position  # in all strings laid end to end
    owner = np.concatenate(where)[at]
    group = np.cumsum(~same)
    total = np.bincount(group, counts[owner])
    flag = np.zeros(len(at), bool)
    flag[at] = total[group] >= 2
    first = np.append(0, np.cumsum(flat_sizes))[:-1]
    return [flag[f : f + len(s) - depth + 1] for f, s in zip(first, strings, strict=True)]

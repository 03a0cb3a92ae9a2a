"""Burrows-Wheeler transforms of string collections, and their merge by interleave refinement.

Every string ends with a mark of its own, less than all bytes, marks in string order. A
shard's transform comes from its suffix array: for each suffix, in their order, the
symbols that stand before it. Shards are merged without sorting suffixes again: the
interleave Z says, place by place, from which shard the merged order takes its next
suffix. It starts as all of shard 0, then all of shard 1 and so on. One refinement gives
every place the next symbol of its shard's transform and sorts the places by it, stably,
which orders the suffixes by one more symbol; after h rounds Z is right for prefixes of
length h, and two neighbours lie in the same block if and only if their first h symbols
agree. So the round in which a block splits is the common prefix of its parts
(``merge``), and the blocks after h rounds are the intervals of strings of length h that
occur more than once (``intervals``).

``intervals`` refines by several symbols a round, as many as one number holds: a transform
then holds the gram before each suffix, and the places are sorted by whole grams. Suffixes
that are shorter than the length reached so far hold their mark, so they repeat nothing and
leave the transforms; suffixes with fewer symbols before them have no suffix to lead to.
"""

from __future__ import annotations

import numpy as np

def collection(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols: bytes plus one and a 0 after each string, places of the marks)."""
    raw = np.frombuffer(b"".join(s + b"\0" for s in strings), dtype=np.uint8)
    symbols = raw.astype(np.uint16) + 1
    ends = np.cumsum([len(s) + 1 for s in strings]) - 1
    symbols[ends] = 0
    return symbols, ends


def lengths_of(n: int, ends: np.ndarray) -> np.ndarray:
    """Symbols of every suffix up to its mark."""
    return np.repeat(ends, np.diff(np.r_[-1, ends])) - np.arange(n)


def suffix_array(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffix array of a collection: ``symbols`` (0 only at ``ends``), by prefix doubling.

    The first round compares as many symbols as one number holds.
    """
    n, length = len(symbols), lengths_of(len(symbols), ends)
    used = np.flatnonzero(np.bincount(symbols, minlength=1))
    code = np.zeros(int(used[-1]) + 1, dtype=np.int64)
    code[used] = np.arange(len(used)) + 1
    dense, base = code[symbols], len(used) + 1
    k = max(1, int(np.log(2.0**62 / len(ends)) / np.log(base)))
    key = np.zeros(n, dtype=np.int64)
    for j in range(k):  # what stands past the mark doesn't count
        key *= base
        m = max(0, n - j)
        key[:m] += np.where(length[:m] >= j, dense[j:], 0)
    key *= len(ends)
    key += np.where(length < k, np.repeat(np.arange(len(ends)), np.diff(np.r_[-1, ends])), 0)  # marks go by string
    while True:
        order = np.argsort(key)
        ranked = key[order]
        new = np.empty(n, dtype=bool)
        new[0] = True
        np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(new) - 1
        if new.all():
            return order
        key, m = rank * (n + 1), max(0, n - k)
        key[:m] += np.where(length[:m] >= k, rank[k:] + 1, 0)
        k *= 2


def transform(symbols: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The symbol before each suffix, in suffix order; 0 before the start of a string."""
    before = np.empty_like(symbols)
    before[1:] = symbols[:-1]
    before[0] = 0
    return before[order]


def merge(transforms: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard of each merged place, block of each place after ``depth`` rounds, common
    prefix of each place with the one before, up to ``depth``), symbol by symbol."""
    sizes = [len(t) for t in transforms]
    n = sum(sizes)
    flat = np.concatenate(transforms)
    z = np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes)
    block = np.zeros(n, dtype=np.int32)
    prefix = np.full(n, depth, dtype=np.int16)
    prefix[:1] = 0
    for length in range(1, depth + 1):
        # symbols before the suffixes in the order of Z: each shard gives its own in turn
        by_shard = np.argsort(z, kind="stable")
        symbol = np.empty(n, dtype=np.uint16)
        symbol[by_shard] = flat
        step = np.argsort(symbol, kind="stable")
        z, symbol, block = z[step], symbol[step], block[step]
        marks = int(np.searchsorted(symbol, 1))
        z[:marks] = np.sort(z[:marks])
        new = np.empty(n, dtype=bool)
        new[0] = True
        new[1:] = (block[1:] != block[:-1]) | (symbol[1:] != symbol[:-1])
        new[:marks] = True
        prefix[new & (prefix == depth)] = length - 1
        block = np.cumsum(new, dtype=np.int32)
    return z, block, prefix


def grams_before(symbols: np.ndarray, ends: np.ndarray, step: int, base: int = 257) -> np.ndarray:
    """The ``step`` symbols (less than ``base``) before every place as one number; 0 where the string has fewer."""
    n = len(symbols)
    begin = np.r_[0, ends[:-1] + 1]
    offset = np.arange(n) - np.repeat(begin, np.diff(np.r_[-1, ends]))
    gram = np.zeros(n, dtype=np.uint64)
    for j in range(min(step, n), 0, -1):
        gram[j:] = gram[j:] * np.uint64(base) + symbols[: n - j]
    gram[offset < step] = 0
    return gram


def _order(symbol: np.ndarray) -> np.ndarray:
    """Stable order of numbers below 2**32, by their halves."""
    if symbol.dtype == np.uint16:
        return np.argsort(symbol, kind="stable")
    low = np.argsort(symbol.astype(np.uint16), kind="stable")
    return low[np.argsort((symbol >> 16).astype(np.uint16)[low], kind="stable")]


def intervals(shards: list[tuple[np.ndarray, np.ndarray, np.ndarray]], depth: int, step: int | None = None) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(shard of each place, ranks of the suffixes in each shard in their order, block of each
    place) of the suffixes with at least ``depth`` symbols, after rounds that add up to ``depth``.

    A shard is (symbols, places of the marks, suffix array). A round takes ``step`` symbols,
    as many as 64 bits hold where it isn't given; the first one what is left over.
    """
    owner = np.uint8 if len(shards) <= 256 else np.uint16
    lengths = [lengths_of(len(s), e)[o].astype(np.int32) for s, e, o in shards]
    z = np.repeat(np.arange(len(shards), dtype=owner), [len(x) for x in lengths])
    block = np.zeros(len(z), dtype=np.int32)
    used = np.flatnonzero(np.bincount(np.concatenate([np.bincount(s, minlength=257).nonzero()[0] for s, _, _ in shards]), minlength=257))
    code = np.zeros(257, dtype=np.uint64)
    code[used] = np.arange(len(used))
    code[1:] += np.uint64(used[0] != 0)  # 0 stays the mark
    base = max(2, int(code.max()) + 1)
    most = 1
    while base ** (most + 1) < 1 << 64:
        most += 1
    step = max(1, min(step or most, most, depth))
    reached, made = 0, (0, [])
    while reached < depth:
        size = step if reached else depth % step or step
        if made[0] != size:
            grams = np.concatenate([grams_before(code[s], e, size, base)[o] for s, e, o in shards])
            if base**size < 65_536:
                places = grams.astype(np.uint16)
            else:
                names, places = np.unique(grams, return_inverse=True)
                if not names[0] == 0:  # 0 is "no gram"
                    places = places + 1
                places = places.astype(np.uint16 if len(names) < 65_535 else np.uint32)
            made = size, np.split(places, np.cumsum([len(x) for x in lengths])[:-1])
        flat = np.concatenate([t[n >= reached] for t, n in zip(made[1], lengths, strict=True)])
        symbol = np.empty_like(flat)
        symbol[np.argsort(z, kind="stable")] = flat  # each shard gives its own in turn
        order = _order(symbol)
        order = order[int(np.count_nonzero(symbol == 0)) :]
        z, block, symbol = z[order], block[order], symbol[order]
        new = np.ones(len(z), dtype=bool)
        new[1:] = (block[1:] != block[:-1]) | (symbol[1:] != symbol[:-1])
        block = np.cumsum(new, dtype=np.int32)
        reached += size
    return z, [np.flatnonzero(n >= depth) for n in lengths], block


def repeated(strings: list[bytes], length: int, shard_bytes: int = 1 << 20, step: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, offset, block) of every suffix whose first ``length`` bytes occur more than once.

    Strings are dealt to two shards at least, of about ``shard_bytes``, so what repeats meets in the merge.
    """
    n = max(2, -(-sum(map(len, strings)) // shard_bytes))
    dealt = [np.arange(k, len(strings), n) for k in range(min(n, len(strings)))]
    if not dealt:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)
    shards = []
    for own in dealt:
        symbols, ends = collection([strings[i] for i in own])
        shards.append((symbols, ends, suffix_array(symbols, ends)))
    z, ranks, block = intervals(shards, length, step)
    string, at = np.empty(len(z), dtype=np.int64), np.empty(len(z), dtype=np.int64)
    by_shard = np.argsort(z, kind="stable")
    whose, where = [], []
    for own, (_, ends, order), rank in zip(dealt, shards, ranks, strict=True):
        place = order[rank]
        which = np.searchsorted(ends, place)
        whose.append(own[which])
        where.append(place - np.r_[0, ends[:-1] + 1][which])
    string[by_shard], at[by_shard] = np.concatenate(whose), np.concatenate(where)
    same = block[1:] == block[:-1]
    many = np.zeros(len(z), dtype=bool)
    many[1:] |= same
    many[:-1] |= same
    return string[many], at[many], block[many]

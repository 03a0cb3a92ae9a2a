import random
import zlib

import pytest

from wagerlens.llm.shard_partition import _needed, minimax_cuts, shard_documents

SCHEMA = "doc_id long, text string, source string, size int, shard string"


class Ends:
    """Group ends in memory, read in cells as the distributed reader does."""

    def __init__(self, ends, resolution):
        self.ends, self.resolution = ends, resolution

    def read(self, stretches):
        cells = max(1, self.resolution // len(stretches))
        out = {}
        for e in self.ends:
            for lo, hi in stretches:
                if lo < e <= hi:
                    key = (lo, (e - lo - 1) // max(1, -(-(hi - lo) // cells)))
                    a, b, n = out.get(key, (e, e, 0))
                    out[key] = (min(a, e), max(b, e), n + 1)
        found = sorted(out.values())
        return found, all(n <= 2 for _, _, n in found)


def best(ends, total, k):
    low = 1
    high = total
    while low < high:
        mid = (low + high) // 2
        if _needed(ends, total, mid, k) is None:
            low = mid + 1
        else:
            high = mid
    return low


@pytest.mark.parametrize("seed", range(60))
def test_minimax_search_equals_plain_search(seed):
    rnd = random.Random(seed)
    sizes = [rnd.choice([1, 5, rnd.randint(1, 400), rnd.randint(1, 30)]) for _ in range(rnd.randint(1, 900))]
    if seed % 3 == 0:
        sizes[rnd.randrange(len(sizes))] = sum(sizes)
    ends, at = [], 0
    for s in sizes:
        at += s
        ends.append(at)
    k = rnd.choice([1, 2, 3, 16])
    cuts = minimax_cuts(Ends(ends, 48), at, k)
    edges = [0, *cuts, at]
    assert len(cuts) < k and set(cuts) <= set(ends)
    assert max(b - a for a, b in zip(edges, edges[1:], strict=False)) == best(ends, at, k)


def test_whole_result(spark):
    rnd = random.Random(5)
    texts = [None, "", "é", "x" * 9000, *("".join(rnd.choice("ab c") for _ in range(rnd.randint(0, 60))) for _ in range(300))]
    rows = [(i if i != 7 else None, rnd.choice(texts[:40] if i % 3 else texts), "s", 1, "z") for i in range(700)]
    rows += rows[:5]
    placed = shard_documents(spark.createDataFrame(rows, SCHEMA), resolution=64)
    assert dict(placed.dtypes) == {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"}
    got = placed.collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32 is None, r.text_crc32 or 0) for r in got) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 1, t is None, zlib.crc32((t or "").encode())) for i, t, *_ in rows
    )
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
        assert r.law == "bytes" and r.grown_shard is None
    for shard in by.values():
        assert sorted(r.slot for r in shard) == list(range(len(shard)))
    of = {}
    for (i, t, *_), r in zip(sorted(rows, key=str), sorted(got, key=str), strict=True):
        del i, r
        of.setdefault(t, set())
    by_id = {}
    for i, t, *_ in rows:
        by_id.setdefault(i, t)
    for r in got:
        of[by_id[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for s in of.values())
    # as small as any contiguous partition of the groups
    groups = {}
    for i, t, *_ in rows:
        first, size = groups.get(t, (None, 0))
        ids = [x for x in (first, i) if x is not None]
        groups[t] = (min(ids, default=None), size + len((t or "").encode()) + 1)
    ends, at = [], 0
    for first, size in sorted(groups.values(), key=lambda g: (g[0] is not None, g[0] or 0)):
        del first
        at += size
        ends.append(at)
    assert max(sum(r.size for r in s) for s in by.values()) == best(ends, at, 16)


def test_empty_table(spark):
    assert shard_documents(spark.createDataFrame([], SCHEMA)).count() == 0

import random
import re

import numpy as np
import pytest

from wagerlens.llm import near_dup
from wagerlens.llm.near_dup import SKETCH_MOST, near_duplicates, odd_sketches, samples

SCHEMA = "doc_id long, text string, n long, bands string, component_id int"


def brute(rows, size=4):
    sets = {}
    for i, t, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if len(words) >= size else ({tuple(words)} if words else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(i for i in sets if i is not None)
    for k, x in enumerate(ids):
        for y in ids[k + 1 :]:
            if sets[x] and sets[y]:
                both = len(sets[x] & sets[y])
                if 100 * both >= 80 * (len(sets[x]) + len(sets[y]) - both):
                    a, b = sorted((find(x), find(y)))
                    root[b] = a
    return sorted(((i, len(sets[i]), find(i), find(i) == i) for i in ids), key=str)


@pytest.mark.parametrize(("seed", "hot", "dense"), [(0, 64, 10**7), (1, 2, 10**7), (2, 2, 0)])
def test_equals_brute_force(spark, monkeypatch, seed, hot, dense):
    monkeypatch.setattr(near_dup, "HOT", hot)
    monkeypatch.setattr(near_dup, "BLOCK_ROWS", 6)
    monkeypatch.setattr(near_dup, "DENSE", dense)
    rnd = random.Random(seed)
    vocabulary = [f"w{k}é" for k in range(300)] + ["The", "the"]
    rows = []
    for g in range(40):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([3, 5, 12, 60, 200]))]
        for _ in range(rnd.choice([1, 1, 2, 4, 9])):
            words = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 6])):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            rows.append((len(rows) * 3 + 1, rnd.choice([" ", "\n", " \t"]).join(words), 1, "x", g))
    # chains: each differs from the next by a little, the ends are far apart
    words = [f"c{k}" for k in range(120)]
    for k in range(25):
        words[k * 4] = f"changed{k}"
        rows.append((5000 - k, " ".join(words), None, None, None))
    rows += [(9000, None, 1, "x", 1), (9001, "", 1, "x", 1), (9002, " \n", 1, "x", 1), (9003, "One two", 1, "x", 1), (9004, "one TWO", 1, "x", 1), (9005, "long " * 40_000, 1, "", 0), (9006, "long " * 30_000, 1, "", 0), (9007, "a\xa0b c d e", 0, "", 0)]
    # a family: all edits of one text, many pairs just over or under the threshold
    base = [f"f{k}" for k in range(100)]
    for k in range(40):
        words = list(base)
        for _ in range(rnd.choice([1, 2, 3, 4])):
            words[rnd.randrange(100)] = f"x{rnd.randrange(10**6)}"
        rows.append((6000 + k, " ".join(words), 1, "x", 1))
    rnd.shuffle(rows)
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_null_and_repeated_ids_and_an_empty_table(spark):
    text = "one two three four five six"
    rows = [(None, text, 1, "", 1), (4, text, 1, "", 1), (4, text, 1, "", 1), (2, text, 1, "", 1)]
    got = sorted((tuple(r) for r in near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == sorted([(None, 3, None, True), (4, 3, 2, False), (4, 3, 2, False), (2, 3, 2, True)], key=str)
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sketches_let_similar_sets_through():
    r = np.random.default_rng(4)
    most = 0
    for _ in range(300):
        x = np.unique(r.integers(0, 2**63, 90, dtype=np.uint64))
        y = np.concatenate((x[10:], r.integers(0, 2**63, 10, dtype=np.uint64)))  # 80 of 100 shared
        a, b = odd_sketches(np.array([samples(x), samples(y)]))
        most = max(most, int(np.bitwise_count((a ^ b).view(np.uint64)).sum()))
    assert most <= SKETCH_MOST - 15


def test_block_links_connect_what_is_linked():
    r = random.Random(3)
    base = [f"f{k}" for k in range(80)]
    texts = []
    for _ in range(60):
        words = list(base)
        for _ in range(r.choice([1, 2, 3])):
            words[r.randrange(80)] = f"x{r.randrange(10**6)}"
        texts.append(" ".join(words))
    sets = near_dup.shingle_sets([t.encode() for t in texts], 4)
    sketch = odd_sketches(np.array([samples(s) for s in sets])).view(np.uint64)
    ids, half = np.arange(60) + 100, np.arange(60) < 30
    for left, right in ((half, ~half), (half, half)):
        want = set()
        for a in np.flatnonzero(left):
            for b in np.flatnonzero(right):
                both = len(np.intersect1d(sets[a], sets[b]))
                if a != b and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    want.add((a, b))

        def parts(links):
            root = list(range(60))

            def find(x):
                return x if root[x] == x else find(root[x])

            for a, b in links:
                root[find(a)] = find(b)
            return [find(x) for x in range(60)]

        got = near_dup.block_links(ids, ids, sketch, texts, left, right, 4)
        assert {(a - 100, b - 100) for a, b in got} <= want
        x, y = parts([(a - 100, b - 100) for a, b in got]), parts(want)
        assert len(set(zip(x, y, strict=True))) == len(set(x)) == len(set(y)) > 1

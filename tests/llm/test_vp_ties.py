"""However many different vectors tie, the smaller id wins, exactly."""

import itertools
import random

import numpy as np
import pytest

from wagerlens.llm.vp_search import nearest

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k):
    ids, m = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=np.float64)
    unit = m / np.linalg.norm(m, axis=1)[:, None]
    out = []
    for j in np.flatnonzero(ids % 50 == 0):
        ok = np.flatnonzero(ids != ids[j])
        c = np.round(unit[ok] @ unit[j], 12)
        out += [(int(ids[j]), r + 1, int(ids[ok[b]])) for r, b in enumerate(np.lexsort((ids[ok], -c))[:k])]
    return sorted(out)


def scaled():
    bases = [(1, 2, 3, 0), (2, 1, 0, 5), (1, 1, 1, 1)]
    return [[float(c * x) for x in base] for base in bases for c in range(1, 61)]


def binary():
    return [[float(x) for x in bits] for bits in itertools.product((0, 1), repeat=9) if any(bits)]


def one_hot():
    return [[float(a == b) for a in range(150)] for b in range(150)]


@pytest.mark.parametrize("make", [scaled, binary, one_hot])
def test_ties_go_to_the_smaller_id(spark, make):
    vectors = make()
    ids = list(range(len(vectors)))
    random.Random(1).shuffle(ids)
    rows = list(zip(ids, vectors, strict=True))
    df = spark.createDataFrame(rows, SCHEMA)
    got = nearest(df, df.filter("vec_id % 50 = 0"), k=5, shard_rows=300).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == brute(rows, 5)

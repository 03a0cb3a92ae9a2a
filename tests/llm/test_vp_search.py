import numpy as np
import pytest

from wagerlens.llm.vp_search import VpTree, _routed, build, nearest

SCHEMA = "vec_id long, embedding array<float>, label int, score string, id int"


def brute(rows, queries, k):
    out = []
    ids = np.array([i for i, _ in rows])
    m = np.array([v for _, v in rows], dtype=np.float64)
    norm = np.sqrt((m * m).sum(1))
    for i, v in queries:
        v = np.array(v, dtype=np.float64)
        c = (m @ v) / (norm * np.sqrt(v @ v))
        ok = np.flatnonzero(ids != i)
        best = ok[np.lexsort((ids[ok], -np.round(c[ok], 12)))][:k]
        out += [(i, r + 1, int(ids[b]), float(c[b])) for r, b in enumerate(best)]
    return out


def data(seed, n, dim):
    r = np.random.default_rng(seed)
    centres = r.standard_normal((6, dim))
    v = (centres[r.integers(0, 6, n)] + 0.3 * r.standard_normal((n, dim))).astype(np.float32)
    v[5:40] = v[4]
    v[200:210] = 2 * v[199]
    return [(int(i), [float(x) for x in row]) for i, row in enumerate(v)]


@pytest.mark.parametrize("dim", [2, 24])
def test_exact_search_equals_brute_force(spark, dim):
    rows = data(dim, 900, dim)
    odd = [(9000, None), (9001, [0.0] * dim), (9002, [float("nan")] * dim), (9003, [float("inf")] + [1.0] * (dim - 1)), (9004, [None] + [1.0] * (dim - 1)), (None, rows[0][1]), (9005, [1.0] * (dim + 1)), rows[3]]
    df = spark.createDataFrame([(i, v, 1, "s", 2) for i, v in rows + odd], SCHEMA)
    got = nearest(df, df.filter("vec_id % 50 = 0"), k=5, shard_rows=200, block_rows=7).collect()
    want = brute(rows, [q for q in rows if q[0] % 50 == 0], 5)
    assert [(r.query_id, r["rank"]) for r in sorted(got)] == [(q, r) for q, r, _, _ in want]
    got = {(r.query_id, r["rank"]): r for r in got}
    for q, r, i, c in want:
        x = got[q, r]
        assert abs(x.score - c) < 1e-12
        assert x.vec_id == i


def test_relaxed_pruning_keeps_recall():
    rows = data(1, 4000, 16)
    m = np.array([v for _, v in rows])
    m = np.unique(m, axis=0)
    tree = VpTree(m, [np.array([i]) for i in range(len(m))], leaf=32)
    exact, _ = tree.search(m[::40], 5, 1.0)
    unit = m / np.linalg.norm(m, axis=1)[:, None]
    d = -(unit[::40] @ unit.T)
    for e, row in zip(exact, d, strict=True):
        assert np.allclose(np.sort(row)[:5], row[e])
    relaxed, _ = tree.search(m[::40], 5, 1.5)
    hit = np.mean([len(set(a) & set(b)) / 5 for a, b in zip(exact.tolist(), relaxed.tolist(), strict=True)])
    assert hit >= 0.9


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 1, "", 1), (50, [0.0, 1.0], 1, "", 1), (7, [1.0, 1.0], 1, "", 1)], SCHEMA)
    got = nearest(df, df.filter("vec_id % 50 = 0")).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [(0, 1, 7), (0, 2, 50), (50, 1, 7), (50, 2, 0)]
    empty = spark.createDataFrame([], SCHEMA)
    assert nearest(empty, empty).count() == 0


def test_queries_leave_out_shards_that_hold_nothing_near(spark):
    r = np.random.default_rng(5)
    rows = [(i, [float(x) for x in np.eye(12)[i % 12] + 0.01 * r.standard_normal(12)]) for i in range(1200)]
    df = spark.createDataFrame([(i, v, 1, "s", 2) for i, v in rows], SCHEMA)
    index = build(df, shard_rows=20)
    asked = df.filter("vec_id % 50 = 0").selectExpr("vec_id as id", "cast(embedding as array<double>) as vector", "cast(0.99 as double) as least")
    every = sum(len(cells) for cells in index.cells.values())
    assert _routed(asked, index, 1.0, False, 1).count() < 24 * every / 2
    got = nearest(df, df.filter("vec_id % 50 = 0"), k=5, shard_rows=100, block_rows=7).collect()
    want = brute(rows, [q for q in rows if q[0] % 50 == 0], 5)
    assert sorted((x.query_id, x["rank"], x.vec_id) for x in got) == sorted(w[:3] for w in want)

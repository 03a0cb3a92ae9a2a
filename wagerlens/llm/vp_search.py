"""Nearest neighbours by cosine over vantage-point trees, one tree per shard.

Vectors are scaled to length one, where the largest cosine is the least Euclidean
distance. A shard's distinct vectors form a tree: a node splits its vectors at the
median distance to a vantage point. A search goes down the nearer side first and visits
the other only if its bound could still hold a neighbour: by the triangle inequality a
vector there is at least ``|distance - radius|`` away. ``factor`` relaxes that: the side is
pruned when ``factor`` times the bound passes the k-th distance found so far, so one
restores exact search, and more prunes harder. All queries of a block go down together.

Every row is indexed. Rows are dealt to the nearest of up to ``PIVOTS`` pivots, a sample of
their own directions; a pivot's rows are one shard, or several of about ``SHARD_ROWS``
where they are more. A query meets the shards of its nearest pivot first. That bounds how
far its neighbours can be, and by the triangle inequality, relaxed by the same factor, it
goes on only to pivots whose rows, all within a known radius, can hold one as near. Queries
come in blocks of about ``BLOCK_ROWS``, so a task holds one tree and one block whatever the
tables' sizes, and a tree travels only to blocks that need it. Entries that rounding leaves in question are scored again,
cosine in double precision on the original vectors, and ranked by score and id at once,
so a tree gives the k best ids of a query however many entries tie; the k best are then
taken over all shards. Equal vectors are one entry of a tree with all their ids.

Defined results: vectors that are null, zero, or hold a null or non-finite component
take no part, nor do null ids; vectors of another length than the query's aren't
compared with it; rows equal in id and vector count once, and rows with the query's own
id are never its neighbours; scores that agree to 12 decimals are ties and go to the
smaller id; empty tables give no rows; extra columns aren't read.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagerlens.llm._io import stage

SHARD_ROWS = 8_192
#: Pivots that the driver and every task hold, at most.
PIVOTS = 1_024
BLOCK_ROWS = 2_048
LEAF = 96
#: Ties are cosines that agree in units of 1 / ``TIE``.
TIE = 1e12
#: Slack for rounding in distances to vantage points, and in cosines (more than a unit of ties).
_EPS, _SLACK = 1e-12, 1e-11
#: Doubles of a chunk of exact scores, and (query, id) pairs of a leaf that are met at once.
_CHUNK, _PAIRS = 2_000_000, 1_000_000


class VpTree:
    """Vantage-point tree over distinct unit vectors; entry i of ``vectors`` has ``ids[i]``."""

    def __init__(self, vectors: np.ndarray, ids: list[np.ndarray], leaf: int = LEAF, seed: int = 3):
        norm = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        self.raw, self.unit, self.ids, self.leaf = vectors, vectors / norm[:, None], ids, leaf
        self.rng = np.random.default_rng(seed)
        self.root = self._build(np.arange(len(vectors)))

    def _build(self, at: np.ndarray):
        if len(at) <= self.leaf:
            return at
        # of a few points, the one from which the others lie most unevenly far
        trial = self.rng.choice(at, min(5, len(at)), replace=False)
        some = self.unit[self.rng.choice(at, min(200, len(at)), replace=False)]
        spread = [np.linalg.norm(some - self.unit[t], axis=1).var() for t in trial]
        point = trial[int(np.argmax(spread))]
        distance = np.linalg.norm(self.unit[at] - self.unit[point], axis=1)
        radius = float(np.median(distance))
        inner = distance <= radius
        if inner.all():  # more than half lie on the sphere
            inner = distance < radius
            if not inner.any():
                return at
            radius = float(distance[inner].max())
        return point, radius, self._build(at[inner]), self._build(at[~inner])

    def scores(self, q: np.ndarray, who: np.ndarray, entry: np.ndarray) -> np.ndarray:
        """Cosines of pairs of queries and entries on the original vectors."""
        out, step = np.empty(len(who)), max(1, _CHUNK // q.shape[1])
        for lo in range(0, len(who), step):
            a, b = q[who[lo : lo + step]], self.raw[entry[lo : lo + step]]
            out[lo : lo + step] = np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))
        return out

    def search(self, queries: np.ndarray, k: int, factor: float, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, cosines) of the k nearest ids of each query but its ``own``; cosine -inf where there are fewer."""
        q = queries / np.sqrt(np.einsum("ij,ij->i", queries, queries))[:, None]
        best = np.full((len(q), k), -np.inf)
        name = np.zeros((len(q), k), dtype=np.int64)
        every = np.concatenate(self.ids) if self.ids else np.empty(0, dtype=np.int64)
        once = len(np.unique(every)) == len(every)
        # k ids of an entry beside the query's own; all where an id has several vectors
        ids = [x[: k + 1] for x in self.ids] if once else self.ids
        sizes = np.array([len(x) for x in ids], dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        flat = np.concatenate(ids) if ids else every

        def meet(node: np.ndarray, who: np.ndarray) -> None:
            c = q[who] @ self.unit[node].T
            least = best[who, -1]
            if once and len(node) > k + 1:  # k + 1 entries hold k ids beside the query's own
                least = np.maximum(least, np.partition(c, -(k + 1), axis=1)[:, -(k + 1)])
            row, col = np.nonzero(c >= (least - _SLACK)[:, None])
            if not len(row):
                return
            exact = self.scores(queries, who[row], node[col])
            n = sizes[node[col]]
            at = np.repeat(starts[node[col]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            some = np.unique(row)
            old = np.isfinite(best[who[some]])
            of = np.concatenate([np.repeat(who[row], n), np.repeat(who[some], k)[old.ravel()]])
            score = np.concatenate([np.repeat(exact, n), best[who[some]][old]])
            vec = np.concatenate([flat[at], name[who[some]][old]])
            if own is not None:
                other = vec != own[of]
                of, score, vec = of[other], score[other], vec[other]
            if not once:
                order = np.lexsort((-score, vec, of))
                of, score, vec = of[order], score[order], vec[order]
                first = np.ones(len(of), dtype=bool)
                first[1:] = (of[1:] != of[:-1]) | (vec[1:] != vec[:-1])
                of, score, vec = of[first], score[first], vec[first]
            order = np.lexsort((vec, -np.rint(score * TIE), of))
            of, score, vec = of[order], score[order], vec[order]
            place = np.arange(len(of)) - np.searchsorted(of, of)
            top = place < k
            best[of[top], place[top]] = score[top]
            name[of[top], place[top]] = vec[top]

        def visit(node, who: np.ndarray) -> None:
            if not len(who):
                return
            if isinstance(node, np.ndarray):
                if len(node):
                    step = max(1, _PAIRS // int(sizes[node].sum()))
                    for lo in range(0, len(who), step):
                        meet(node, who[lo : lo + step])
                return
            point, radius, inner, outer = node
            d = np.linalg.norm(q[who] - self.unit[point], axis=1)
            inside = d <= radius
            visit(inner, who[inside])
            visit(outer, who[~inside])
            bound = factor * (np.abs(d - radius) - _EPS)

            def open_(part: np.ndarray) -> np.ndarray:
                return who[part & (bound <= np.sqrt(np.maximum(0, 2 - 2 * best[who, -1]) + 2 * _SLACK))]

            visit(outer, open_(inside))
            visit(inner, open_(~inside))

        visit(self.root, np.arange(len(q)))
        return name, best


def usable(vector: Column) -> Column:
    """Not null, every component finite, and not all zero."""
    x = vector.cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(x, lambda c: c != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    return np.asarray(flat.flatten(), dtype=np.float64).reshape(len(flat), -1)


def _tree_of(table: pa.Table) -> pa.Table:
    ids, vectors = np.asarray(table["id"]), _matrix(table["vector"])
    distinct, where = np.unique(vectors, axis=0, return_inverse=True)
    order = np.lexsort((ids, where.ravel()))
    cut = np.flatnonzero(np.diff(where.ravel()[order])) + 1
    own = [np.unique(x) for x in np.split(ids[order], cut)]
    blob = pickle.dumps(VpTree(distinct, own), protocol=5)
    place = {k: pa.array([table[k][0].as_py()], pa.int32()) for k in ("dim", "cell", "part")}
    return pa.table({**place, "tree": pa.array([blob], pa.binary())})


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def _by_length(batch: pa.RecordBatch, column: int):
    """(rows, their vectors as a matrix) for each length of vector in a batch."""
    vectors = batch.column(column)
    sizes = np.asarray(vectors.value_lengths())
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        yield at, np.asarray(vectors.take(pa.array(at)).flatten(), dtype=np.float64).reshape(len(at), int(dim))


def _nearest_pivot(unit: np.ndarray, pivots: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(nearest pivot, distance to it) of unit vectors; -1 where no pivot has their length."""
    known = pivots.get(unit.shape[1])
    if known is None:
        return np.full(len(unit), -1), np.zeros(len(unit))
    cell = (unit @ known.T).argmax(axis=1)
    return cell, np.linalg.norm(unit - known[cell], axis=1)


class Index:
    """Trees by dim, cell and part, with the pivots and the reach of every cell."""

    def __init__(self, trees: DataFrame, pivots: dict[int, np.ndarray], cells: dict[int, dict[int, tuple[float, int]]]):
        self.trees, self.pivots, self.cells = trees, pivots, cells


def build(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS, pivots: int = PIVOTS) -> Index:
    """The index of all rows, its trees written to the shared folder."""
    rows = df.filter(usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    n = rows.count()
    some = rows.orderBy(F.xxhash64("id"), "id").limit(max(1, min(pivots, -(-n // shard_rows)))).select("vector").collect()
    known: dict[int, list] = {}
    for r in some:
        known.setdefault(len(r[0]), []).append(r[0])
    known = {d: _unit(np.array(v)) for d, v in known.items()}

    def deal(batches):
        for batch in batches:
            dim, cell, far = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            for at, vectors in _by_length(batch, 1):
                dim[at] = vectors.shape[1]
                cell[at], far[at] = _nearest_pivot(_unit(vectors), known)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(dim), pa.array(cell), pa.array(far)], names=["id", "vector", "dim", "cell", "far"])

    dealt = stage(rows.mapInArrow(deal, "id long, vector array<double>, dim int, cell int, far double"), "vp-rows")
    cells: dict[int, dict[int, tuple[float, int]]] = {}
    for r in dealt.groupBy("dim", "cell").agg(F.max("far").alias("reach"), F.ceil(F.count("*") / shard_rows).cast("int").alias("parts")).collect():  # at most a pivot each
        cells.setdefault(r["dim"], {})[r["cell"]] = (r["reach"] if r["cell"] >= 0 else 2.0, r["parts"])
    parts = dealt.sparkSession.createDataFrame([(d, c, x[1]) for d, own in cells.items() for c, x in own.items()], "dim int, cell int, parts int")
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    sharded = dealt.join(F.broadcast(parts), ["dim", "cell"]).select("id", "vector", "dim", "cell", part.alias("part"))
    trees = sharded.groupBy("dim", "cell", "part").applyInArrow(_tree_of, "dim int, cell int, part int, tree binary")
    return Index(stage(trees, "vp-trees"), known, cells)


def _routed(queries: DataFrame, index: Index, factor: float, home: bool, blocks: int) -> DataFrame:
    """id, vector, dim, cell, part, block: the shards that a query meets: those of its home pivot,
    else all others that can hold a vector as near as its column ``least``, a cosine, says."""
    pivots, cells = index.pivots, index.cells

    def run(batches):
        for batch in batches:
            rows, dims, where, parts = [], [], [], []
            for at, vectors in _by_length(batch, 1):
                own = cells.get(vectors.shape[1])
                if not own:
                    continue
                names = np.array(sorted(own))
                reach, n = np.array([own[c][0] for c in names]), np.array([own[c][1] for c in names])
                unit = _unit(vectors)
                if vectors.shape[1] in pivots:
                    cosine = unit @ pivots[vectors.shape[1]][names].T
                    first = names[cosine.argmax(axis=1)]
                    # a lower bound of the distance to any row of the cell
                    free = np.sqrt(np.maximum(0, 2 - 2 * cosine - 1e-13)) - reach - _EPS
                else:
                    first, free = np.full(len(at), -1), np.zeros((len(at), len(names)))
                if home:
                    go = names[None, :] == first[:, None]
                else:
                    least = np.asarray(batch.column(2).fill_null(-1.0))[at]
                    limit = np.sqrt(np.maximum(0, 2 - 2 * least) + 2 * _SLACK)
                    go = (names[None, :] != first[:, None]) & (factor * free <= limit[:, None])
                q, c = np.nonzero(go)
                times = n[c]
                rows.append(np.repeat(at[q], times))
                where.append(np.repeat(names[c], times))
                parts.append(np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times))
                dims.append(np.full(int(times.sum()), vectors.shape[1]))
            at, dim, cell, part = (np.concatenate(x).astype(np.int32) if x else np.empty(0, np.int32) for x in (rows, dims, where, parts))
            for lo in range(0, len(at), 4096):
                some = slice(lo, lo + 4096)
                taken = batch.take(pa.array(at[some]))
                yield pa.RecordBatch.from_arrays([taken.column(0), taken.column(1), pa.array(dim[some]), pa.array(cell[some]), pa.array(part[some])], names=["id", "vector", "dim", "cell", "part"])

    met = queries.mapInArrow(run, "id long, vector array<double>, dim int, cell int, part int")
    return met.withColumn("block", F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(blocks)).cast("int"))


def _searched(met: DataFrame, index: Index, k: int, factor: float) -> DataFrame:
    """query_id, vec_id, score, tie: the k best of every shard that a query meets."""
    met = stage(met, "vp-met")
    key = ["dim", "cell", "part", "block"]
    spread = index.trees.join(met.select(*key[:3], F.col("block").alias("of")).distinct(), key[:3])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)}
        if left.num_rows and right.num_rows:
            ids, q = np.asarray(left["id"]), _matrix(left["vector"])
            names, cosines = pickle.loads(right["tree"][0].as_py()).search(q, k, factor, ids)
            who, place = np.nonzero(np.isfinite(cosines))
            out = {"query_id": ids[who], "vec_id": names[who, place], "score": cosines[who, place]}
        return pa.table({**{c: pa.array(x) for c, x in out.items()}, "tie": pa.array(np.rint(out["score"] * TIE).astype(np.int64))})

    return stage(met.groupBy(*key).cogroup(spread.groupBy(*key[:3], "of")).applyInArrow(search, "query_id long, vec_id long, score double, tie long"), "vp-found")


def nearest(df: DataFrame, queries: DataFrame, k: int = 5, factor: float = 1.0, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of ``df`` to each row of ``queries``."""
    index = build(df, id_col, vector_col, shard_rows)
    asked = queries.filter(usable(F.col(vector_col)) & F.col(id_col).isNotNull())
    asked = asked.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    asked = stage(asked.groupBy("id").agg(F.min("vector").alias("vector")), "vp-queries")
    blocks = max(1, -(-asked.count() // block_rows))
    from pyspark.sql import Window

    best = Window.partitionBy("query_id").orderBy(F.desc("tie"), "vec_id")  # a few candidates from each shard

    def ranked(found: DataFrame) -> DataFrame:
        once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"), F.max("tie").alias("tie"))
        return once.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)

    near = _searched(_routed(asked, index, factor, True, blocks), index, k, factor)
    least = ranked(near).filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("least"))
    open_ = asked.join(least, "id", "left").select("id", "vector", "least")
    found = near.unionByName(_searched(_routed(open_, index, factor, False, blocks), index, k, factor))
    return ranked(found).select("query_id", "rank", "vec_id", "score")

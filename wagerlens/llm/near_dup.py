"""Near-duplicate documents: banded MinHash, odd sketches, links confirmed on full sets.

1. A document becomes the set of its distinct word shingles, as 64-bit hashes. Equal
   sets are one class from here on (thousands of copies are one row), numbered in the
   order of its smallest id, so that classes which share that id stay apart.
2. ``BANDS`` x ``ROWS`` MinHash samples of each class give band keys and an odd sketch:
   every sample flips one bit of a bitmap, so the ones of the XOR of two bitmaps count
   the samples that differ, and the similarity follows from that count.
3. The members of a band's bucket are paired with the bucket's smallest member only,
   and pairs whose sizes or sketches rule the similarity out are dropped. The rest is
   confirmed on the full sets, made anew from the texts.
4. Connected components. Where a bucket of three or more still holds members of
   different components, the pairs across components are tested too, so no link between
   classes is lost to step 3: a bucket's pairs within one component can't change the
   result. In buckets of up to ``HOT`` members the pairs are joined. Larger buckets that
   share members form families; a family is cut into blocks, and a task takes two blocks,
   compares sketches and sets in memory, and gives only links that connect components.
   So no family's pairs are ever written out, and no task holds more than two blocks.

At a similarity of 0.8 a pair shares no band in 5 of 10^8 cases; the sketch test drops
only pairs whose estimate lies more than six standard deviations below 0.8.

Defined results: a document without words (or null) has n_shingles 0 and stands alone;
one with fewer words than a shingle has its whole sequence as one shingle; a row with a
null id stands alone, its component is null and it is kept; every distinct (id, text)
is a node of its own, and rows that repeat one are each returned; a component is named
by its smallest id, and of several texts of that id in it one is kept; an empty table
gives an empty table; extra columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagerlens.llm._io import numbered, slices, stage
from wagerlens.llm.components import components

BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
#: Bits of an odd sketch, and the ones of an XOR above which 0.8 is ruled out.
SKETCH_BITS, SKETCH_MOST = 512, 112
#: Members of a bucket whose pairs are joined; larger ones are compared in blocks of
#: about so many members and bytes of text.
HOT, BLOCK_ROWS, BLOCK_BYTES = 32, 512, 4_000_000
#: Shingles of two blocks whose intersections are counted by a matrix product.
DENSE = 2_000_000
#: Bytes of text that are cut into words at once.
BATCH_BYTES = 4_000_000

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MULT = _rng.integers(0, 2**32, SAMPLES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 2**32, SAMPLES, dtype=np.uint64).astype(np.uint32)


def mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def word_hashes(raw: np.ndarray, doc_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in ``raw``, words of each document). Words never cross documents."""
    if not len(raw):
        return np.empty(0, dtype=np.uint64), np.zeros(len(doc_starts) - 1, dtype=np.int64)
    space = _SPACE[raw]
    begin = ~space
    begin[1:] &= space[:-1]
    inner = doc_starts[1:-1]
    inner = inner[inner < len(raw)]
    begin[inner] = ~space[inner]
    starts = np.flatnonzero(begin)
    if not len(starts):
        return np.empty(0, dtype=np.uint64), np.zeros(len(doc_starts) - 1, dtype=np.int64)
    word = np.cumsum(begin) - 1
    keep = ~space
    at = np.flatnonzero(keep)
    of = word[at]
    place = at - starts[of]
    powers = np.cumprod(np.full(int(place.max()) + 1, _BASE, dtype=np.uint64))
    sums = np.add.reduceat(_BYTE[raw[at]] * powers[place], np.searchsorted(of, np.arange(len(starts))))
    counts = np.searchsorted(starts, doc_starts[1:]) - np.searchsorted(starts, doc_starts[:-1])
    return mix(sums), counts


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
    starts = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    words, counts = word_hashes(raw, starts)
    out, lo = [], 0
    factors = mix(np.arange(1, size + 1, dtype=np.uint64) * _BASE) | np.uint64(1)
    for n in counts.tolist():
        w = words[lo : lo + n]
        lo += n
        if n == 0:
            out.append(w)
            continue
        k = min(n, size)
        s = np.full(n - k + 1, k, dtype=np.uint64) * _BASE
        for j in range(k):
            s += w[j : j + n - k + 1] * factors[j]
        out.append(np.unique(mix(s)))
    return out


def samples(shingles: np.ndarray) -> np.ndarray:
    """MinHash samples of a set, as unsigned 32-bit integers."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(SAMPLES, 2**32 - 1, dtype=np.uint32)
    for lo in range(0, len(x), 2048):
        part = x[lo : lo + 2048]
        least = np.minimum(least, (np.multiply.outer(_MULT, part) + _ADD[:, None]).min(axis=1))
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """(document, band) keys of sample rows."""
    m = least.reshape(len(least), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _BASE, m.shape[:2]).copy()
    for j in range(ROWS):
        key = mix((key ^ m[:, :, j]) * _BASE)
    return key.view(np.int64)


def odd_sketches(least: np.ndarray) -> np.ndarray:
    """Parity bitmaps of sample rows, as 64-bit words."""
    bit = (mix(least.astype(np.uint64) * np.uint64(SAMPLES) + np.arange(SAMPLES, dtype=np.uint64) + _BASE) % np.uint64(SKETCH_BITS)).astype(np.int64)
    parity = np.zeros((len(least), SKETCH_BITS), dtype=np.uint8)
    np.bitwise_xor.at(parity, (np.arange(len(least))[:, None], bit), 1)
    return np.packbits(parity, axis=1, bitorder="little").view("<i8")


def text_hash(text_col: str) -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(F.col(text_col).cast("string"))


def described(df: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """id, h (hash of the text), n, hi, lo (fingerprint of the set), bands, sketch of every row."""
    schema = "id long, h long, n long, hi long, lo long, bands array<long>, sketch array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, 2, BATCH_BYTES)):
            sets = shingle_sets([(t or "").encode() for t in batch.column(2).to_pylist()], size)
            least = np.array([samples(s) for s in sets]).reshape(-1, SAMPLES)
            sums = [(len(s), int(s.sum(dtype=np.uint64)), int(mix(s ^ _BASE).sum(dtype=np.uint64))) for s in sets]
            n, hi, lo = (np.array(x, dtype=np.uint64).view(np.int64) for x in zip(*sums, strict=True))
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(0, k * len(x) + 1, k), pa.int32()), pa.array(x.ravel())) for x, k in ((band_keys(least), BANDS), (odd_sketches(least), SKETCH_BITS // 64))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), pa.array(hi), pa.array(lo), *lists], names=["id", "h", "n", "hi", "lo", "bands", "sketch"])

    return df.select(F.col(id_col).cast("long").alias("id"), text_hash(text_col).alias("h"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def _near(a: str, b: str):
    """Whether sizes and sketches leave a similarity of 0.8 possible (``n`` and ``sketch``)."""
    ones = sum(F.bit_count(F.col(f"{a}sketch")[i].bitwiseXOR(F.col(f"{b}sketch")[i])) for i in range(SKETCH_BITS // 64))
    n, m = F.col(f"{a}n"), F.col(f"{b}n")
    return (100 * F.least(n, m) >= 80 * F.greatest(n, m)) & (ones <= SKETCH_MOST)


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= 80 * union."""
    left = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, 2, BATCH_BYTES)):
            memo: dict[str, np.ndarray] = {}
            columns = [batch.column(k).to_pylist() for k in (2, 3)]
            some = list({t for c in columns for t in c})
            memo.update(zip(some, shingle_sets([t.encode() for t in some], size), strict=True))
            keep = []
            for x, y in zip(*columns, strict=True):
                sx, sy = memo[x], memo[y]
                shared = len(sx) + len(sy) - len(np.unique(np.concatenate((sx, sy))))
                keep.append(100 * shared >= 80 * (len(sx) + len(sy) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def near_duplicates(df: DataFrame, size: int = 4, id_col: str = "doc_id", text_col: str = "text", hash_col: str | None = None) -> DataFrame:
    """id, n_shingles, component_id, kept of every row, and ``text_hash`` as ``hash_col`` if that is named."""
    rows = stage(described(df, size, id_col, text_col), "near-rows")
    sets = rows.filter("n > 0 and id is not null")
    classes = sets.groupBy("n", "hi", "lo").agg(F.min(F.struct("id", "h")).alias("of"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    classes = numbered(classes.select("n", "hi", "lo", "of.id", "of.h", "bands", "sketch"), ["id", "h", "n", "hi", "lo"], "rep")
    keyed = classes.select("rep", F.explode("bands").alias("key"))
    buckets = stage(keyed.groupBy("key").agg(F.min("rep").alias("least"), F.count("*").alias("members")).filter("members > 1"), "near-buckets")
    members = stage(keyed.join(buckets, "key"), "near-members")
    brief = classes.select("rep", "n", "sketch")

    def sided(side: str) -> DataFrame:
        return brief.select(*(F.col(c).alias(f"{side}_{c}") for c in brief.columns))

    stars = members.filter("rep > least").select(F.col("rep").alias("a"), F.col("least").alias("b")).distinct()
    stars = stars.join(sided("a"), F.col("a") == F.col("a_rep")).join(sided("b"), F.col("b") == F.col("b_rep"))
    stars = stage(stars.filter(_near("a_", "b_")).select("a", "b"), "near-stars")
    needed = classes.join(members.select("rep").distinct(), "rep", "left_semi").select("rep", "id", "h")
    source = df.select(F.col(id_col).cast("long").alias("id"), text_hash(text_col).alias("h"), F.col(text_col).cast("string").alias("text"))
    # the text that the class is named for, from the rows that repeat it
    texts = source.join(needed, ["id", "h"]).groupBy("rep").agg(F.min("text").alias("text")).withColumnRenamed("rep", "id")
    texts = stage(texts, "near-texts")
    links = stage(_confirmed(stars, texts, size), "near-links")
    found = components(links)
    opened = stage(_open(members, found, brief), "near-open")
    if not opened.isEmpty():
        rest = _rest(opened.filter(F.col("members") <= HOT), stars)
        links = stage(links.union(_confirmed(stage(rest, "near-rest"), texts, size)).union(_family_links(opened.filter(F.col("members") > HOT), texts, size)), "near-links")
        found = components(links)
    # ids of one class meet in the smallest id, classes in that of the smallest class
    heads = found.join(classes.select(F.col("rep").alias("component"), F.col("id").alias("head_id"), F.col("h").alias("head_h")), "component")
    of_set = classes.join(heads.withColumnRenamed("node", "rep"), "rep", "left").select("n", "hi", "lo", F.coalesce("head_id", "id").alias("component"), F.coalesce("head_h", "h").alias("head_h"))
    out = rows.select("id", "h", "n", "hi", "lo").join(of_set, ["n", "hi", "lo"], "left")
    component = F.when(F.col("id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "id"))
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce((F.col("id") == F.col("component")) & (F.col("h") == F.col("head_h")), F.lit(True)).alias("kept"),
        *([F.col("h").alias(hash_col)] if hash_col else []),
    )


def _open(members: DataFrame, found: DataFrame, brief: DataFrame) -> DataFrame:
    """Members of buckets of three or more that hold several components."""
    now = members.filter("members > 2").join(found.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", "least", "members", F.coalesce("component", "rep").alias("component"))
    mixed = now.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("key")
    return now.join(mixed, "key").join(brief, "rep")


def _rest(opened: DataFrame, tested: DataFrame) -> DataFrame:
    """Untested pairs across components of buckets of bounded size, as far as sketches allow."""
    a = opened.select("key", *(F.col(c).alias(f"a_{c}") for c in ("rep", "component", "n", "sketch")))
    b = opened.select("key", *(F.col(c).alias(f"b_{c}") for c in ("rep", "component", "n", "sketch")))
    pairs = a.join(b, "key").filter((F.col("a_rep") > F.col("b_rep")) & (F.col("a_component") != F.col("b_component")) & _near("a_", "b_"))
    return pairs.select(F.col("a_rep").alias("a"), F.col("b_rep").alias("b")).distinct().join(tested, ["a", "b"], "left_anti")


def _family_links(opened: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """Links across components within families of large buckets, by pairs of blocks."""
    families = components(opened.filter("rep > least").select(F.col("rep").alias("a"), F.col("least").alias("b")))
    docs = opened.groupBy("rep").agg(F.min("component").alias("component"), F.min("n").alias("n"), F.min("sketch").alias("sketch"))
    docs = docs.join(families.select(F.col("node").alias("rep"), F.col("component").alias("family")), "rep", "left").withColumn("family", F.coalesce("family", "rep"))
    docs = stage(docs.join(texts.withColumnRenamed("id", "rep"), "rep"), "near-families")
    sizes = docs.groupBy("family").agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum(F.octet_length("text")) / BLOCK_BYTES)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = docs.join(sizes, "family").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("family", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "component", "n", "sketch", "text")

    def compare(table: pa.Table) -> pa.Table:
        links = block_links(
            np.asarray(table["rep"]), np.asarray(table["component"]), np.array(table["sketch"].to_pylist(), dtype=np.int64).view(np.uint64), table["text"].to_pylist(),
            np.asarray(table["own"]) == table["i"][0].as_py(), np.asarray(table["own"]) == table["j"][0].as_py(), size,
        )
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return dealt.groupBy("family", "i", "j").applyInArrow(compare, "a long, b long")


def block_links(ids: np.ndarray, component: np.ndarray, sketch: np.ndarray, texts: list[str], left: np.ndarray, right: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Links between the ``left`` and ``right`` rows that connect different components, a forest of them."""
    rows, cols = np.flatnonzero(left), np.flatnonzero(right)
    ones = np.zeros((len(rows), len(cols)), dtype=np.int32)
    for k in range(sketch.shape[1]):
        ones += np.bitwise_count(sketch[rows, k][:, None] ^ sketch[cols, k][None, :])
    maybe = (ones <= SKETCH_MOST) & (component[rows][:, None] != component[cols][None, :])
    rows, cols, maybe = rows[maybe.any(1)], cols[maybe.any(0)], maybe[maybe.any(1)][:, maybe.any(0)]
    if not maybe.size:
        return []
    sets = dict(zip(used := np.union1d(rows, cols), shingle_sets([texts[k].encode() for k in used], size), strict=True))
    n = {k: len(s) for k, s in sets.items()}
    na, nb = np.array([n[k] for k in rows]), np.array([n[k] for k in cols])
    maybe &= 100 * np.minimum(na[:, None], nb) >= 80 * np.maximum(na[:, None], nb)
    shared = np.zeros(maybe.shape, dtype=np.int64)
    if sum(n.values()) <= DENSE:
        names, where = np.unique(np.concatenate([sets[k] for k in used]), return_inverse=True)
        of = np.repeat(np.arange(len(used)), [n[k] for k in used])
        order = np.argsort(where, kind="stable")
        where, of = where[order], of[order]
        ra, cb = np.searchsorted(used, rows), np.searchsorted(used, cols)
        for lo in range(0, len(names), 4096):
            x, y = np.searchsorted(where, (lo, lo + 4096))
            part = np.zeros((len(used), min(4096, len(names) - lo)), dtype=np.float32)
            part[of[x:y], where[x:y] - lo] = 1
            shared += (part[ra] @ part[cb].T).astype(np.int64)
    else:
        for a, b in zip(*np.nonzero(maybe), strict=True):
            shared[a, b] = len(np.intersect1d(sets[rows[a]], sets[cols[b]], assume_unique=True))
    linked = maybe & (100 * shared >= 80 * (na[:, None] + nb - shared))
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    out = []
    for a, b in zip(*np.nonzero(linked), strict=True):
        x, y = find(int(component[rows[a]])), find(int(component[cols[b]]))
        if x != y:
            root[x] = y
            out.append((int(ids[rows[a]]), int(ids[cols[b]])))
    return out

"""Removal of repeated byte strings: every 100-byte string that starts earlier already.

The answer is exact over the whole corpus, and no task ever holds more than a bounded
piece of it. Hashes deal strings that may be equal to one place and group what is equal
in whole; what repeats is decided by merged transforms:

1. Every 100-byte window of a text is assigned to an anchor, the least 32-byte gram
   inside it by a hash, leftmost of equal ones. The anchor depends on the window's bytes
   alone, so equal windows have equal anchors. The windows of one anchor start side by
   side; this run is the unit that moves, as two hashes, an id and a place (no text).
2. Runs meet by anchor. Of equal runs the first two stand for all: what the second
   repeats all further ones repeat. Second runs that stand side by side, as their first
   ones do, make a pair of equal stretches. Of an anchor's runs that differ, the first of
   each kind goes on; a run whose anchor no other run has is done with.
3. Their bytes are fetched. A pair of stretches is a group of its own. Runs that differ
   are cut into pieces of up to ``PIECE`` windows, which meet by a hash of the bytes that
   all windows of the piece hold; of equal pieces again the first two stand for all.
   Where more than ``GROUP_MOST`` meet, each of their windows is a piece of its own.
4. Each batch of groups is dealt to shards with a Burrows-Wheeler transform each, equal
   strings to different ones; these are merged by interleave refinement (see ``bwt``),
   and the blocks after 100 symbols are the strings that occur more than once. All their
   places but the first are repeats.
5. Repeats are united per document.

Order is by id, then place. Defined results: a null text is empty; texts of fewer bytes
than the length keep all; null ids come first, rows of one id in order of a hash of
their text; rows equal in id and text are one document and get the same result;
an empty table gives an empty table; extra columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagerlens.llm import bwt
from wagerlens.llm._io import numbered, slices, stage, trim

GRAM = 32
PIECE = 23
#: Bytes of text whose windows are described at once (fewer than 2**23).
BATCH_BYTES = 4_000_000
#: Runs that a task holds before it passes them on.
RUNS = 1_500_000
#: Bytes of a stretch of equal runs.
STRETCH = 1 << 16
#: Bytes of pieces that one merge takes (whole groups), and of one of its shards: what a core's cache holds.
MERGE_BYTES, SHARD_BYTES = 128_000, 64_000
#: Pieces of a group beyond which its windows go apart.
GROUP_MOST = 8_000

_rng = np.random.default_rng(977)
_TABLES = _rng.integers(0, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = _rng.integers(0, 2**63, (2, 16), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _rolling(raw: np.ndarray, table: int, width: int) -> np.ndarray:
    """Hash of the ``width`` (a power of 2) bytes from each place on, by doubling."""
    h = _TABLES[table][raw]
    k = 1
    for level in range(width.bit_length() - 1):
        h = h[:-k] * _FACTORS[table, level] + h[k:]
        k *= 2
    return h


def runs(raw: np.ndarray, doc_starts: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """The runs of ``raw``: anchor hash, content hash, document, start, windows, anchor place."""
    grams = length - GRAM + 1
    empty = {k: np.empty(0, dtype=np.int64) for k in ("key", "content", "doc", "start", "windows", "anchor")}
    if len(raw) < length:
        return empty
    h = mix(_rolling(raw, 0, GRAM))
    least = (h & ~np.uint64((1 << 23) - 1)) | np.arange(len(h), dtype=np.uint64)
    k = 1
    while 2 * k <= grams:
        least = np.minimum(least[:-k], least[k:])
        k *= 2
    if grams > k:
        rest = grams - k
        least = np.minimum(least[:-rest], least[rest:])
    anchor = (least & np.uint64((1 << 23) - 1)).astype(np.int64)
    n = len(raw) - length + 1
    anchor = anchor[:n]
    sizes = np.diff(doc_starts)
    doc = np.repeat(np.arange(len(sizes)), sizes)[:n]
    valid = np.arange(n) + length <= doc_starts[1:][doc]
    at = np.flatnonzero(valid)
    if not len(at):
        return empty
    a, d = anchor[at], doc[at]
    cut = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (d[1:] != d[:-1])])
    first, windows = at[cut], np.diff(np.r_[cut, len(at)])
    a, d = a[cut], d[cut]
    size = windows + length - 1
    wide = _rolling(raw, 1, 64)
    parts = (first, first + (size - 64) // 2, first + size - 64)
    content = (size * 131 + (a - first)).astype(np.uint64) * _FACTORS[0, 10]
    for j, p in enumerate(parts):
        content = mix(content + wide[p] * _FACTORS[1, 11 + j])
    return {"key": h[a].view(np.int64), "content": content.view(np.int64), "doc": d, "start": first - doc_starts[d], "windows": windows, "anchor": a - doc_starts[d]}


def _places(key: np.ndarray, order: tuple[np.ndarray, ...]) -> np.ndarray:
    """Place of each row, by ``order``, among those with its ``key``: 0, 1, ..."""
    by = np.lexsort((*reversed(order), key))
    k = key[by]
    start = np.r_[True, k[1:] != k[:-1]]
    out = np.empty(len(key), dtype=np.int64)
    at = np.arange(len(key))
    out[by] = at - np.maximum.accumulate(np.where(start, at, 0))
    return out


def _spans(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans united per document where they touch or overlap."""
    by = np.lexsort((start, doc))
    doc, start, end = doc[by], start[by], end[by]
    if not len(doc):
        return doc, start, end
    base = np.cumsum(np.r_[0, doc[1:] != doc[:-1]]) * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + base)
    new = np.r_[True, start[1:] + base[1:] > reach[:-1]]
    at = np.flatnonzero(new)
    return doc[at], start[at], (reach - base)[np.r_[at[1:] - 1, len(doc) - 1]]


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))


def _described(docs: DataFrame, length: int) -> DataFrame:
    """Rows key, content, ord, start, windows: the first two runs of their kind in the task; and,
    with null content and windows as an end, the further ones."""
    schema = "key long, content long, ord long, start long, windows long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            key, content, ord_, start, windows = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            both = (mix(key.view(np.uint64)) + content.view(np.uint64)).view(np.int64)
            first = _places(both, (ord_, start)) < 2
            yield from _in_parts(_batch(key=key[first], content=content[first], ord=ord_[first], start=start[first], windows=windows[first]))
            o, s, e = _spans(ord_[~first], start[~first], (start + windows + length - 1)[~first])
            if len(o):
                route = mix(o.view(np.uint64) + np.uint64(7)).view(np.int64)
                yield from _in_parts(_batch(key=route, content=pa.nulls(len(o), pa.int64()), ord=o, start=s, windows=e))

        for batch in (s for b in batches for s in slices(b, 1, BATCH_BYTES)):
            ids = np.asarray(batch.column(0))
            texts = [t.encode() for t in batch.column(1).to_pylist()]
            for raw, starts, index, base in _buffers(texts, length):
                r = runs(raw, starts, length)
                held.append((r["key"], r["content"], ids[index][r["doc"]], r["start"] + base[r["doc"]], r["windows"]))
            if sum(len(x[0]) for x in held) > RUNS:
                yield from flush()
        if held:
            yield from flush()

    return docs.select("ord", "text").mapInArrow(run, schema)


def _in_parts(batch: pa.RecordBatch, rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    for lo in range(0, batch.num_rows, rows):
        yield batch.slice(lo, rows)


def _buffers(texts: list[bytes], length: int, most: int = 1 << 22) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts joined to buffers of at most about ``most`` bytes: bytes, starts, and for each
    part the index of its text and its place in it.

    A longer text is given in stretches that overlap by a window's bytes less one, so that
    each of its windows lies in one stretch.
    """
    parts = [(i, at, t[at : at + most + length - 1]) for i, t in enumerate(texts) for at in range(0, max(1, len(t) - length + 1), most)]
    lo = 0
    while lo < len(parts):
        hi, size = lo, 0
        while hi < len(parts) and (hi == lo or size + len(parts[hi][2]) <= most):
            size += len(parts[hi][2])
            hi += 1
        some = parts[lo:hi]
        raw = np.frombuffer(b"".join(p for _, _, p in some), dtype=np.uint8)
        starts = np.cumsum([0, *(len(p) for _, _, p in some)]).astype(np.int64)
        yield raw, starts, np.array([i for i, _, _ in some]), np.array([at for _, at, _ in some], dtype=np.int64)
        lo = hi


def _met(described: DataFrame, length: int) -> DataFrame:
    """Runs met by anchor, of three kinds: the first run of each content of an anchor that has
    several (key; ``end``: its windows); the second run of a content with the place of the
    first (no key, ord1 and start1; ``end``: its windows); and the spans of further ones."""
    schema = "key long, ord long, start long, end long, ord1 long, start1 long"
    sorted_ = described.repartition("key").sortWithinPartitions("key", "content", "ord", "start")
    names = [x.split()[0] for x in schema.split(", ")]

    def rows(key, ord_, start, end, ord1=None, start1=None) -> pa.RecordBatch:
        n = len(ord_)
        return pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()) if x is None else pa.array(x, pa.int64()) for x in (key, ord_, start, end, ord1, start1)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen, first = None, 0, (0, 0)  # the last (key, content), its rows so far, its first (ord, start)
        waiting = None  # the first run of the last key, while the key has one content
        for batch in batches:
            told = np.asarray(batch.column(1).is_null())
            key, ord_, start, windows = (np.asarray(batch.column(k)) for k in (0, 2, 3, 4))
            if told.any():
                yield rows(None, ord_[told], start[told], windows[told])
            content = np.asarray(batch.column(1).fill_null(0))[~told]
            key, ord_, start, windows = (x[~told] for x in (key, ord_, start, windows))
            n = len(key)
            if not n:
                continue
            at = np.arange(n)
            new_key = np.r_[last is None or key[0] != last[0], key[1:] != key[:-1]]
            new_class = new_key | np.r_[last is None or content[0] != last[1], content[1:] != content[:-1]]
            head = np.maximum.accumulate(np.where(new_class, at, 0))
            place, ord1, start1 = at - head, ord_[head], start[head]
            if not new_class[0]:  # the last class runs on
                ends = np.flatnonzero(new_class)
                stop = int(ends[0]) if len(ends) else n
                place[:stop] += seen
                ord1[:stop], start1[:stop] = first
            group = np.cumsum(new_key)
            classes = np.bincount(group, weights=new_class, minlength=int(group[-1]) + 1)
            several = classes[group] > 1
            if not new_key[0]:  # the last key runs on, with a class or more before
                own = group == group[0]
                several[own] = classes[group[0]] > 0 or (waiting is None and seen > 0)
                if several[0] and waiting is not None:
                    yield rows(*(np.array([x]) for x in waiting))
                    waiting = None
            else:
                waiting = None
            go = several & (place == 0)
            if go.any():
                yield rows(key[go], ord_[go], start[go], windows[go])
            pair = place == 1
            if pair.any():
                yield rows(None, ord_[pair], start[pair], windows[pair], ord1[pair], start1[pair])
            again = place > 1
            if again.any():
                yield rows(None, *_spans(ord_[again], start[again], (start + windows + length - 1)[again]))
            began = np.flatnonzero(new_key)
            if len(began):  # the last key began here
                i = int(began[-1])
                waiting = None if several[-1] else (key[i], ord_[i], start[i], windows[i])
            last, seen, first = (key[-1], content[-1]), int(place[-1]) + 1, (int(ord1[-1]), int(start1[-1]))

    return sorted_.mapInArrow(run, schema)


def _stretches(pairs: DataFrame, length: int) -> DataFrame:
    """Rows pkey, ord, start, size: both sides of pairs of equal runs, joined where runs of the
    second side stand side by side and their first ones do too."""
    sorted_ = pairs.select("ord", "ord1", "start", "start1", F.col("end").alias("windows")).repartition("ord").sortWithinPartitions("ord", "ord1", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # a stretch that is cut by a batch's edge is two
            if not batch.num_rows:
                continue
            ord_, ord1, start, start1, windows = (np.asarray(c) for c in batch.columns)
            new = np.ones(len(ord_), dtype=bool)
            new[1:] = (ord_[1:] != ord_[:-1]) | (ord1[1:] != ord1[:-1]) | (start[1:] != (start + windows)[:-1]) | ((start1 - start)[1:] != (start1 - start)[:-1])
            base = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            new |= (start - start[base]) // STRETCH != np.r_[0, ((start - start[base]) // STRETCH)[:-1]]
            at = np.flatnonzero(new)
            end = np.r_[at[1:], len(new)] - 1
            size = (start + windows)[end] - start[at] + length - 1
            pkey = (mix(mix(ord_[at].view(np.uint64)) + start[at].view(np.uint64))).view(np.int64)
            yield _batch(pkey=np.r_[pkey, pkey], ord=np.r_[ord_[at], ord1[at]], start=np.r_[start[at], start1[at]], size=np.r_[size, size])

    return sorted_.mapInArrow(run, "pkey long, ord long, start long, size long")


def _pieces(docs: DataFrame, runs_: DataFrame, stretches: DataFrame, length: int) -> DataFrame:
    """Rows pkey, piece, ord, start: the windows of runs that differ, in pieces, and the stretches."""
    import xxhash

    none = F.lit(None).cast("long")
    asked = runs_.select("ord", F.struct("start", F.col("end").alias("size"), none.alias("pkey")).alias("r")).union(stretches.select("ord", F.struct("start", "size", "pkey").alias("r")))
    wanted = asked.groupBy("ord").agg(F.collect_list("r").alias("runs"))  # bounded by the document
    both = docs.join(wanted, "ord").select("ord", "text", "runs.start", "runs.size", "runs.pkey")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, 1, BATCH_BYTES)):
            pkey, piece, ord_, at = [], [], [], []
            for o, text, starts, sizes, keys in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                raw = text.encode()
                for s, w, whole in zip(starts, sizes, keys, strict=True):
                    if whole is not None:
                        pkey.append(whole)
                        piece.append(raw[s : s + w])
                        ord_.append(o)
                        at.append(s)
                        continue
                    a = s + int(anchor_of(raw[s : s + length]))
                    # windows by their distance to the anchor, in equal steps whatever the run
                    lo = s
                    while lo < s + w:
                        k = (a - lo) // PIECE
                        hi = min(s + w, a - k * PIECE + 1)
                        core = raw[a - k * PIECE : a - k * PIECE - PIECE + 1 + length]
                        pkey.append(xxhash.xxh3_64_intdigest(core, seed=k) - (1 << 63))
                        piece.append(raw[lo : hi + length - 1])
                        ord_.append(o)
                        at.append(lo)
                        lo = hi
            yield _batch(pkey=pa.array(pkey, pa.int64()), piece=pa.array(piece, pa.binary()), ord=pa.array(ord_, pa.int64()), start=pa.array(at, pa.int64()))

    return both.mapInArrow(run, "pkey long, piece binary, ord long, start long")


def anchor_of(window: bytes) -> int:
    """Place of a window's anchor: its least gram by hash, the leftmost of equal ones."""
    h = mix(_rolling(np.frombuffer(window, dtype=np.uint8), 0, GRAM)) >> np.uint64(23)
    return int(h.argmin())


def _merged(pieces: DataFrame, length: int) -> DataFrame:
    """Rows ord, start, end: repeats among pieces, by merged transforms of their shards."""
    sorted_ = pieces.repartition("pkey").sortWithinPartitions("pkey", "piece", "ord", "start")

    def settle(strings: list[bytes], ord_: list[int], start: list[int]) -> pa.RecordBatch:
        own, offset, block = bwt.repeated(strings, length, SHARD_BYTES)
        o, s = np.array(ord_, dtype=np.int64)[own], np.array(start, dtype=np.int64)[own] + offset
        by = np.lexsort((s, o, block))  # a window that stands in several strings is one place
        o, s, block = o[by], s[by], block[by]
        head = np.maximum.accumulate(np.where(np.r_[True, block[1:] != block[:-1]], np.arange(len(o)), 0)) if len(o) else by
        late = (o != o[head]) | (s != s[head])
        o, s, e = _spans(o[late], s[late], s[late] + length)
        return _batch(ord=o, start=s, end=e)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings: list[bytes] = []
        ord_: list[int] = []
        start: list[int] = []
        group = 0  # where the pieces of the last key begin
        size = equal = 0
        last_key = None
        for batch in batches:
            again: list[tuple[int, int, int]] = []
            for key, piece, o, s in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if key != last_key:
                    if len(strings) == group + 1:  # a single piece has nothing to meet
                        size -= len(strings.pop())
                        ord_.pop()
                        start.pop()
                    if size > MERGE_BYTES:
                        yield settle(strings, ord_, start)
                        strings, ord_, start, size = [], [], [], 0
                    last_key, group, equal = key, len(strings), 0
                elif piece == strings[-1]:
                    equal += 1
                    if equal > 1:  # two stand for all
                        again.append((o, s, s + len(piece)))
                        continue
                else:
                    equal = 0
                strings.append(piece)
                ord_.append(o)
                start.append(s)
                size += len(piece)
            if again:
                o_, s_, e_ = _spans(*(np.array(x, dtype=np.int64) for x in zip(*again, strict=True)))
                yield _batch(ord=o_, start=s_, end=e_)
        if len(strings) == group + 1:
            strings.pop(), ord_.pop(), start.pop()
        if strings:
            yield settle(strings, ord_, start)
        trim()

    return sorted_.mapInArrow(run, "ord long, start long, end long")


def _apart(pieces: DataFrame, length: int) -> DataFrame:
    """Every window of the pieces as a piece of its own, dealt by its bytes."""
    each = pieces.select("ord", "start", "piece", F.explode(F.sequence(F.lit(0), F.octet_length("piece") - length)).alias("k"))
    window = F.expr(f"substring(piece, k + 1, {int(length)})")
    return each.select(F.xxhash64(window).alias("pkey"), window.alias("piece"), "ord", (F.col("start") + F.col("k")).alias("start"))


def repeated_spans(docs: DataFrame, length: int = 100) -> DataFrame:
    """ord, starts, ends: the repeated byte spans of each document that has any, unsorted.

    ``docs`` has ``ord`` (the order, unique) and ``text`` (not null).
    """
    met = stage(_met(_described(docs, length), length), "runs-met")
    stretches = _stretches(met.filter("ord1 is not null"), length)
    pieces = stage(_pieces(docs, met.filter("key is not null"), stretches, length), "pieces")
    large = stage(pieces.groupBy("pkey").agg(F.count("*").alias("n")).filter(F.col("n") > GROUP_MOST).select("pkey"), "pieces-large")
    if not large.isEmpty():
        pieces = pieces.join(large, "pkey", "left_anti").unionByName(_apart(pieces.join(large, "pkey", "left_semi"), length))
    spans = met.filter("key is null and ord1 is null").select("ord", "start", "end").union(stage(_merged(pieces, length), "pieces-merged"))
    return stage(spans.groupBy("ord").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends")), "spans")


def _kept(raw: bytes, starts: list[int] | None, ends: list[int] | None) -> tuple[list[bytes], list[tuple[int, int]]]:
    """(bytes that stay, maximal removed spans)."""
    spans: list[tuple[int, int]] = []
    for s, e in sorted(zip(starts or (), ends or (), strict=True)):
        if spans and s <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(e, spans[-1][1]))
        else:
            spans.append((s, e))
    kept, at = [], 0
    for s, e in spans:
        kept.append(raw[at:s])
        at = e
    kept.append(raw[at:])
    return kept, spans


def whole_characters(raw: bytes, spans: list[tuple[int, int]]) -> str:
    """The text without the characters that lie wholly inside the spans."""
    kept, at = [], 0
    for s, e in spans:
        while s < e and raw[s] & 0xC0 == 0x80:  # the span begins inside a character
            s += 1
        while e > s and e < len(raw) and raw[e] & 0xC0 == 0x80:  # it ends inside one
            e -= 1
        kept.append(raw[at:s])
        at = max(at, e)
    kept.append(raw[at:])
    return b"".join(kept).decode()


OUTPUTS: dict[str, tuple[str, Callable]] = {
    "n_bytes": ("long", lambda raw, kept, spans: len(raw)),
    "n_removed": ("long", lambda raw, kept, spans: sum(e - s for s, e in spans)),
    "n_spans": ("long", lambda raw, kept, spans: len(spans)),
    "kept_sha256": ("string", lambda raw, kept, spans: hashlib.sha256(b"".join(kept)).hexdigest()),
    "kept": ("binary", lambda raw, kept, spans: b"".join(kept)),
    "kept_text": ("string", lambda raw, kept, spans: whole_characters(raw, spans)),
}


def remove_repeats(df: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", outputs: tuple[str, ...] = ("kept",), keep_columns: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: the id column, ``keep_columns`` and ``outputs`` (of ``OUTPUTS``)."""
    asked = tuple(outputs)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = df.select(F.col(id_col).alias("id"), text.alias("text"), *(F.col(c).alias(f"__{c}") for c in keep_columns))
    others = [f"__{c}" for c in keep_columns]
    plain = df.select(id_col).filter(F.col(id_col).isNull()).isEmpty() and df.groupBy(id_col).count().filter("count > 1").isEmpty()
    if plain:
        docs = source.withColumn("ord", F.col("id").cast("long"))
        distinct = docs.select("ord", "text")
    else:  # an order of the distinct (id, text)
        keys = numbered(source.select("id", F.xxhash64("text").alias("hash")).distinct(), ["id", "hash"], "ord")
        hashed = source.withColumn("hash", F.xxhash64("text"))
        docs = hashed.alias("s").join(keys.alias("k"), F.col("s.id").eqNullSafe(F.col("k.id")) & (F.col("s.hash") == F.col("k.hash"))).select("s.*", "k.ord").drop("hash")
        distinct = docs.groupBy("ord").agg(F.min("text").alias("text"))
    spans = repeated_spans(distinct, length)
    both = docs.join(spans, "ord", "left").select("id", *others, "text", "starts", "ends")

    from pyspark.sql.types import StructField, StructType

    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = StructType([StructField(id_col, df.schema[id_col].dataType), *(StructField(c, df.schema[c].dataType) for c in keep_columns)])
    for k in asked:
        schema = schema.add(f"{k}", OUTPUTS[k][0])
    width = 1 + len(others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, width, BATCH_BYTES)):
            cols: dict[str, list] = {k: [] for k in asked}
            for text_, starts, ends in zip(*(batch.column(width + k).to_pylist() for k in range(3)), strict=True):
                raw = text_.encode()
                kept, spans_ = _kept(raw, starts, ends)
                for k, v in cols.items():
                    v.append(OUTPUTS[k][1](raw, kept, spans_))
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *(pa.array(v, kinds[OUTPUTS[k][0]]) for k, v in cols.items())], names=schema.names)

    return both.mapInArrow(run, schema)

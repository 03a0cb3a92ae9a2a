"""Token ids as binary shard files with a minimal perfect hash index.

A shard is two files. ``.bin`` holds the ids of its documents as little-endian
unsigned integers, of 16 bits where the vocabulary allows, else of 32. ``.idx`` holds
the offset of every record and a minimal perfect hash: levels of bit arrays, in
which a key that shares its place with no other sets its bit and the rest go on to
the next level. The rank of the bit is the key's slot, and the slot stores a 32-bit
fingerprint, which turns foreign keys away, the first record and the number of
records. A lookup costs a constant number of probes. Keys themselves aren't stored.

Documents are range-partitioned and sorted by id, so the shards in order hold all
documents in ascending order. A task streams its ids to files under names of its own
and reports them; only reported files belong to the set, so a task that is run again
after a loss, or twice, leaves no trace in the result. The manifest has one row per
shard of up to ``SHARD_IDS`` ids, with the range of its keys: ``lookup`` deals keys to
the shards that may hold them and finds every record through the index.

The library sees white-space-free words once per memo (see ``_library``): its
normaliser and pattern never join characters across white space, and texts that may
hold a special token's string are given to it whole.

Defined results: a null or empty text is the end id alone; rows with a null id come
first and are not indexed (``without_id`` reads them); repeated ids stand side by side, in order of their text,
and their slot gives all; an empty table gives no shard; extra columns aren't read.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagerlens.llm import _library
from wagerlens.llm._io import held, new_path, slices

#: Ids of a shard before the next is begun.
SHARD_IDS = 32_000_000
_MAGIC = b"WLIX0001"


# ---------------------------------------------------------------- minimal perfect hash


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A bijective mix of unsigned 64-bit integers."""
    z = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct int64 keys onto 0..n-1."""

    def __init__(self, sizes: list[int], bits: np.ndarray, n: int):
        self.sizes, self.bits, self.n = sizes, bits, n
        self.starts = np.cumsum([0, *sizes])
        counts = np.bitwise_count(bits).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    @classmethod
    def build(cls, keys: np.ndarray, gamma: float = 1.5) -> PerfectHash:
        left = keys.astype(np.int64).view(np.uint64)
        sizes, levels = [], []
        while len(left):
            size = max(64, (int(gamma * len(left)) + 63) // 64 * 64)
            at = (mix(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size)[at] == 1
            on = np.zeros(size, dtype=np.uint8)
            on[at[alone]] = 1
            levels.append(np.packbits(on, bitorder="little"))
            sizes.append(size)
            left = left[~alone]
        raw = np.concatenate(levels) if levels else np.empty(0, dtype=np.uint8)
        return cls(sizes, raw.view("<u8"), len(keys))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where no level has a bit; a foreign key may get any slot."""
        x = keys.astype(np.int64).view(np.uint64)
        out = np.full(len(x), -1, dtype=np.int64)
        open_ = np.arange(len(x))
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            at = (mix(x[open_], level) % np.uint64(size)).astype(np.int64) + self.starts[level]
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (self.bits[word] >> bit & np.uint64(1)).astype(bool)
            below = self.bits[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[open_[hit]] = (self.before[word] + np.bitwise_count(below).astype(np.int64))[hit]
            open_ = open_[~hit]
        return out


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys.astype(np.int64).view(np.uint64), 977) >> np.uint64(32)).astype("<u4")


def index_bytes(ids: np.ndarray, null: np.ndarray, counts: np.ndarray, width: int) -> bytes:
    """The .idx file: offsets in file order, null ids first, and slots of the distinct other ids."""
    offsets = np.concatenate(([0], np.cumsum(counts))).astype("<i8")
    at = np.flatnonzero(~null)
    keys, first, run = np.unique(ids[at], return_index=True, return_counts=True)
    ph = PerfectHash.build(keys)
    slot = ph.slots(keys)
    by_slot = np.empty(len(keys), dtype=np.int64)
    by_slot[slot] = np.arange(len(keys))
    arrays = {
        "bits": ph.bits.astype("<u8"),
        "prints": fingerprint(keys)[by_slot],
        "first": at[first][by_slot].astype("<i8"),
        "run": run[by_slot].astype("<i8"),
        "offsets": offsets,
    }
    head = json.dumps({"width": width, "sizes": ph.sizes, "n": len(keys), "nulls": int(null.sum()), "arrays": [[k, a.dtype.str, len(a)] for k, a in arrays.items()]}).encode()
    return b"".join([_MAGIC, struct.pack("<I", len(head)), head, *(a.tobytes() for a in arrays.values())])


class Shard:
    """Keyed and sequential access to one shard."""

    def __init__(self, base: str):
        fs, path = _filesystem(base)
        with fs.open_input_file(path + ".idx") as f:
            raw = f.read()
        if raw[:8] != _MAGIC:
            raise ValueError(f"{base}.idx is no shard index")
        (n,) = struct.unpack_from("<I", raw, 8)
        head, at, self.a = json.loads(raw[12 : 12 + n]), 12 + n, {}
        for name, kind, size in head["arrays"]:
            self.a[name] = np.frombuffer(raw, dtype=kind, count=size, offset=at)
            at += self.a[name].nbytes
        self.hash = PerfectHash(head["sizes"], self.a["bits"], head["n"])
        self.nulls = head["nulls"]
        self.kind = np.dtype("<u2" if head["width"] == 2 else "<u4")
        self.file = fs.open_input_file(path + ".bin")

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first record, number of records) of each key; -1 and 0 for keys not here."""
        slot = self.hash.slots(keys)
        if not self.hash.n:
            return np.full(len(keys), -1), np.zeros(len(keys), dtype=np.int64)
        known = (slot >= 0) & (self.a["prints"][slot] == fingerprint(keys))
        return np.where(known, self.a["first"][slot], -1), np.where(known, self.a["run"][slot], 0)

    def ids(self, record: int, records: int = 1) -> np.ndarray:
        lo, hi = self.a["offsets"][record], self.a["offsets"][record + records]
        self.file.seek(int(lo) * self.kind.itemsize)
        return np.frombuffer(self.file.read(int(hi - lo) * self.kind.itemsize), dtype=self.kind)


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


# ---------------------------------------------------------------- encoding


class WordEncoder:
    """Ids of whole texts, packed as unsigned integers, for a tokenizer that drops white space."""

    def __init__(self, path: str, separator: str):
        self.tokenizer = _library.load(path)
        self.separator = separator
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.kind = "<u2" if self.width == 2 else "<u4"
        self.last = _library.last_tokens(self.tokenizer)
        self.memo: dict[bytes, bytes] = {}

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.kind).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.memo) > _library.MEMO:
            self.memo = {}
        memo, out, waiting, new = self.memo, [], [], set()
        for text in texts:
            if text and "<|" in text:  # may hold a special token's string
                out.append(self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids))
                continue
            words = text.encode().split() if text else []
            got = list(map(memo.get, words))
            if None in got:
                new.update([w for w, v in zip(words, got, strict=True) if v is None])
                waiting.append((len(out), words))
                out.append(b"")
            else:
                out.append(b"".join(got))
        self._learn(new)
        for i, words in waiting:
            out[i] = b"".join(map(memo.__getitem__, words))
        return out

    def _learn(self, new: set[bytes]) -> None:
        parts: dict[bytes, tuple[bytes, bytes]] = {}
        todo: set[bytes] = set()
        for w in new:
            stem, marks = _library.stem_and_marks(w.decode())
            stem_b = stem.lower().encode() if stem.isascii() else stem.encode()
            parts[w] = (stem_b, marks.encode())
            todo.update(parts[w])
        todo.discard(b"")
        todo.difference_update(self.memo)
        words = [w.decode() for w in todo]
        plain = [w for w in words if _library.plain_word(w)]
        others = [w for w in words if not _library.plain_word(w)]
        for some, found in ((plain, _library.encode_plain(self.tokenizer, self.last, self.separator, plain)), (others, _library.encode_apart(self.tokenizer, self.separator, others))):
            for w, ids in zip(some, found, strict=True):
                self.memo[w.encode()] = self._pack(ids)
        for w, (stem, marks) in parts.items():
            self.memo[w] = self.memo.get(stem, b"") + self.memo.get(marks, b"")


def word_encoder(path: str, separator: str) -> WordEncoder:
    return held(("token_shards", path, separator), lambda: WordEncoder(path, separator))


def write_shards(
    df: DataFrame,
    root: str,
    tokenizer_path: str,
    end_id: int,
    separator: str = "<|startoftext|>",
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_ids: int = SHARD_IDS,
) -> list[dict]:
    """Write ``df`` as shards under ``root`` and return the manifest, in file order."""
    spark = df.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    read = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    ordered = read.repartitionByRange(n, "id").sortWithinPartitions("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer_path, separator)
        end = encoder._pack([end_id])
        part, made, out = TaskContext.get().partitionId(), [], None

        def close() -> None:
            out.close()
            ids, null, counts = (np.concatenate(x) for x in zip(*records, strict=True))
            with fs.open_output_stream(f"{base}.idx") as f:
                f.write(index_bytes(ids, null, counts, encoder.width))
            own = ids[~null]
            made.append((part, len(made), f"{root}/{name}", len(ids), int(counts.sum()), int(null.sum()), *((int(own[0]), int(own[-1])) if len(own) else (None, None))))

        for batch in (s for b in batches for s in slices(b, 1, _library.BATCH_BYTES)):
            if out is None:
                name = f"shard-{part:05d}-{len(made):03d}-{uuid.uuid4().hex}"
                fs, base = _filesystem(f"{root}/{name}")
                fs.create_dir(base.rpartition("/")[0], recursive=True)
                out, records = fs.open_output_stream(f"{base}.bin"), []
            payload = [p + end for p in encoder.encode(batch.column(1).to_pylist())]
            out.write(b"".join(payload))
            counts = np.fromiter(map(len, payload), dtype=np.int64, count=len(payload)) // encoder.width
            null = np.asarray(batch.column(0).is_null())
            records.append((np.asarray(batch.column(0).fill_null(0)), null, counts))
            if sum(int(c.sum()) for _, _, c in records) >= shard_ids:
                close()
                out = None
        if out is not None:
            close()
        cols = list(zip(*made, strict=True)) or [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds.values(), strict=True)], names=list(kinds))

    kinds = {"part": pa.int32(), "seq": pa.int32(), "base": pa.string(), **dict.fromkeys(("records", "ids", "nulls", "first_key", "last_key"), pa.int64())}
    found = ordered.mapInArrow(run, "part int, seq int, base string, records long, ids long, nulls long, first_key long, last_key long").collect()  # one row a shard
    manifest, start = [], 0
    for r in sorted(found, key=lambda r: (r["part"], r["seq"])):
        manifest.append({**{k: r[k] for k in ("base", "records", "ids", "nulls", "first_key", "last_key")}, "start": start})
        start += r["ids"]
    return manifest


#: Columns of a record that is read.
_READ = {"doc_id": "long", "start": "long", "n_tokens": "long", "ids_crc32": "long", "ids": "array<long>"}


def _rows(shard: Shard, start: int, keys: np.ndarray, records: np.ndarray, null: bool, payload: bool, most: int = 2000) -> Iterator[pa.RecordBatch]:
    """The ``records`` (ascending) of ``keys``; records that stand side by side are read at once."""
    cuts = np.flatnonzero(np.diff(records) != 1) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(records)], strict=True):
        for a in range(lo, hi, most):
            b = min(hi, a + most)
            raw = shard.ids(int(records[a]), b - a).astype("<u4")
            offsets = shard.a["offsets"][records[a] : records[a] + b - a + 1]
            cut = (offsets - offsets[0]).tolist()
            view = memoryview(raw.tobytes())
            crc = [zlib.crc32(view[4 * x : 4 * y]) for x, y in zip(cut, cut[1:], strict=False)]
            columns = [pa.array(keys[a:b], pa.int64(), mask=np.full(b - a, null)), pa.array(offsets[:-1] + start), pa.array(np.diff(offsets)), pa.array(crc, pa.int64())]
            if payload:
                columns.append(pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(raw.astype(np.int64))))
            yield pa.RecordBatch.from_arrays(columns, names=list(_READ)[: len(columns)])


def _schema(payload: bool) -> str:
    return ", ".join(f"{k} {v}" for k, v in list(_READ.items())[: 5 if payload else 4])


def lookup(keys: DataFrame, manifest: list[dict], id_col: str = "doc_id", payload: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, with ``payload``, ids of every record of the distinct ``keys``.

    Keys go to the shards whose range holds them; there each is found through the index
    and its records are read by their offsets. Keys that no shard holds give no row.
    """
    spark = keys.sparkSession
    shards = [m for m in manifest if m["first_key"] is not None]
    if not shards:
        return spark.createDataFrame([], _schema(payload))
    first, last = (np.array([m[k] for m in shards], dtype=np.int64) for k in ("first_key", "last_key"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0))
            lo, hi = np.searchsorted(last, ids, "left"), np.searchsorted(first, ids, "right")
            n = np.maximum(hi - lo, 0)  # several only for an id whose records cross an edge
            shard = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
            yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int32)), pa.array(np.repeat(ids, n))], names=["shard", "id"])

    asked = keys.select(F.col(id_col).cast("long").alias("id")).filter("id is not null").distinct()
    dealt = asked.mapInArrow(deal, "shard int, id long").repartition("shard").sortWithinPartitions("shard", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, at = None, -1
        for batch in batches:
            which, ids = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for k in np.unique(which):
                if k != at:
                    opened, at = Shard(shards[k]["base"]), k
                own = ids[which == k]
                record, n = opened.find(own)
                order = np.argsort(record, kind="stable")
                own, record, n = (x[order][n[order] > 0] for x in (own, record, n))
                place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                yield from _rows(opened, shards[k]["start"], np.repeat(own, n), np.repeat(record, n) + place, False, payload)

    return dealt.mapInArrow(run, _schema(payload))


def without_id(spark: SparkSession, manifest: list[dict], payload: bool = True) -> DataFrame:
    """The records of rows without an id, which no key leads to: the first ones of their shards."""
    some = [(m["base"], m["start"]) for m in manifest if m["nulls"]]
    if not some:
        return spark.createDataFrame([], _schema(payload))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = Shard(base)
                yield from _rows(shard, start, np.zeros(shard.nulls, np.int64), np.arange(shard.nulls), True, payload)

    return spark.createDataFrame(some, "base string, start long").repartition(len(some)).mapInArrow(run, _schema(payload))


def read_back(keys: DataFrame, manifest: list[dict], id_col: str = "doc_id") -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every record: by key, and those without an id."""
    return lookup(keys, manifest, id_col, payload=False).unionByName(without_id(keys.sparkSession, manifest, payload=False))


def token_shards(df: DataFrame, tokenizer_path: str, end_id: int = 1) -> DataFrame:
    """Write the shards of ``df`` to the shared folder and read all records back."""
    root = new_path(df.sparkSession, "token-shards")
    return read_back(df, write_shards(df, root, tokenizer_path, end_id))

"""Byte-level BPE encoding and decoding by corpus-level merge replay.

Texts are cut by the public split pattern. The distinct pieces that a task has
not met yet form one corpus of words; all merges are replayed over that corpus in
rank order. An inverted index leads from the rank of a token pair to the positions
where the pair stands, so a merge touches only those positions and the two
neighbours of each. Pieces repeat by Zipf's law, so the memo of encoded segments
makes the cost follow the distinct words, and it is bounded: beyond ``MEMO``
entries it is dropped and filled again, which never changes a result.

Defined results: a null or empty text has no ids (n_tokens 0, digests of the
empty string); a null ``doc_id`` and repeated rows pass through row by row; extra
input columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagerlens.llm._io import held, slices, trim

#: Entries of a memo before it is dropped.
MEMO = 300_000
#: Bytes of distinct words that one replay takes; a longer word is replayed alone.
REPLAY_BYTES = 8_000_000
#: Bytes of text that are split and joined at once: a worker's memory follows it.
BATCH_BYTES = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class MergeReplay:
    """Encoder and decoder for a rank table; ``pattern`` splits a text into pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.pieces = regex.compile(pattern).findall
        self.vocab = {v: k for k, v in ranks.items()}
        self.decimal = {b"%d" % v: k for k, v in ranks.items()}
        self.digits = {v: b"%d" % v for v in ranks.values()}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        keys, merged = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    merged.append(rank)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.pair_keys = np.array(keys, dtype=np.int64)[order]
        self.pair_rank = np.array(merged, dtype=np.int64)[order]
        self.forget()

    def forget(self) -> None:
        """Drop the memos, as at the end of a task."""
        self.words: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == key, self.pair_rank[at], -1)

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, number of ids of each): merges in rank order,
        the leftmost place of a word first."""
        if not any(words):
            return np.empty(0, dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        buf = np.frombuffer(b"".join(words), dtype=np.uint8)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths)
        n = len(buf)
        sym = self.byte_ids[buf]
        word = np.repeat(np.arange(len(words)), lengths)
        nxt = np.arange(1, n + 1)
        nxt[ends[lengths > 0] - 1] = -1
        prv = np.arange(-1, n - 1)
        starts = ends - lengths
        prv[starts[lengths > 0]] = -1
        rank = np.full(n, -1, dtype=np.int64)
        inner = np.flatnonzero(nxt >= 0)
        rank[inner] = self._rank(sym[inner], sym[inner + 1])
        alive = np.ones(n, dtype=bool)
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def enter(at: np.ndarray) -> None:
            """Put positions into the index under the rank of the pair that begins there."""
            of = rank[at]
            at, of = at[of >= 0], of[of >= 0]
            if not len(at):
                return
            order = np.argsort(of, kind="stable")
            at, of = at[order], of[order]
            cuts = np.flatnonzero(of[1:] != of[:-1]) + 1
            lo = 0
            for hi in (*cuts.tolist(), len(at)):
                r = int(of[lo])
                if r in index:
                    index[r].append(at[lo:hi])
                else:
                    index[r] = [at[lo:hi]]
                    heapq.heappush(heap, r)
                lo = hi

        enter(inner)
        while heap:
            r = heapq.heappop(heap)
            found = index.pop(r)
            at = np.unique(np.concatenate(found) if len(found) > 1 else found[0])
            at = at[rank[at] == r]
            if not len(at):
                continue
            if len(at) > 1:
                at, later = self._at_once(r, at, word, sym, nxt, prv)
                if len(later):
                    index[r] = [later]
                    heapq.heappush(heap, r)
            gone = nxt[at]
            after = nxt[gone]
            sym[at] = r
            nxt[at] = after
            alive[gone] = False
            rank[gone] = -1
            has = after >= 0
            prv[after[has]] = at[has]
            rank[at] = -1
            right = at[has]
            rank[right] = self._rank(sym[right], sym[after[has]])
            before = prv[at]
            left = before[before >= 0]
            rank[left] = self._rank(sym[left], sym[nxt[left]])
            enter(np.concatenate((left, right)))
        ids = sym[alive]
        return ids, np.bincount(word[alive], minlength=len(words))

    def _at_once(self, r: int, at: np.ndarray, word: np.ndarray, sym: np.ndarray, nxt: np.ndarray, prv: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places to merge now, places that wait).

        A word's places are merged from the left, all in one step, if no pair that
        arises on the way has a lower rank; else only the leftmost now.
        """
        w = word[at]
        same = w[1:] == w[:-1]
        if not same.any():
            return at, at[:0]
        several = np.zeros(len(at), dtype=bool)
        several[1:] |= same
        several[:-1] |= same
        some = at[several]
        after, before = nxt[nxt[some]], prv[some]
        merged = np.full(len(some), r, dtype=np.int64)
        right = np.where(after >= 0, self._rank(merged, sym[after]), -1)
        left = np.where(before >= 0, self._rank(sym[before], merged), -1)
        twice = self._rank(merged[:1], merged[:1])[0]
        early = ((right >= 0) & (right < r)) | ((left >= 0) & (left < r)) | (0 <= twice < r)
        first = np.r_[True, ~same]
        careful = np.isin(w, np.unique(word[some[early]])) if early.any() else np.zeros(len(at), dtype=bool)
        # of overlapping places (aaaa) every second one, counted from the left
        linked = np.r_[False, nxt[at[:-1]] == at[1:]]
        place = np.arange(len(at))
        run = place - np.maximum.accumulate(np.where(linked, 0, place))
        take = np.where(careful, first, run % 2 == 0)
        return at[take], at[careful & ~first]

    def _learn(self, words: Iterable[str]) -> None:
        """Encode the words that are not in the memo."""
        todo: list[str] = []
        size = 0

        def flush() -> None:
            ids, counts = self.replay([w.encode() for w in todo])
            shown = list(map(self.digits.__getitem__, ids.tolist()))
            lo = 0
            for w, n in zip(todo, counts.tolist(), strict=True):
                self.words[w] = b" ".join(shown[lo : lo + n])
                lo += n
            todo.clear()

        for w in words:
            raw = w.encode()
            whole = self.ranks.get(raw)
            if whole is not None:
                self.words[w] = b"%d" % whole
                continue
            todo.append(w)
            size += len(raw)
            if size > REPLAY_BYTES:
                flush()
                size = 0
        flush()

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text as decimal numbers joined by one space."""
        if max(len(self.words), len(self.spaced)) > MEMO:
            self.forget()
        cut: list[tuple[list, list[str], list]] = []
        new: set[str] = set()
        for text in texts:
            head, tail = segments(text) if text else ([], [])
            known = list(map(self.spaced.get, tail))
            if None in known:
                new.update([s for s, v in zip(tail, known, strict=True) if v is None])
                known = []
            cut.append(([w for h in head for w in self.pieces(h)], tail, known))
        split = {s: self._spaced_pieces(s) for s in new}
        missing = {w for p in split.values() for w in p}
        missing.update(w for head, _, _ in cut for w in head)
        words = self.words
        self._learn([w for w in missing if w not in words])
        spaced = self.spaced
        for s, p in split.items():
            spaced[s] = words[p[0]] if len(p) == 1 else b" ".join([words[w] for w in p])
        return [b" ".join([words[w] for w in head] + (known or [spaced[s] for s in tail])) for head, tail, known in cut]

    def _spaced_pieces(self, segment: str) -> tuple[str, ...] | list[str]:
        """Pieces of a space and the segment; plain words need no general pattern."""
        m = _plain(segment)
        if m:
            return (" " + m[1], m[2]) if m[2] else (" " + segment,)
        return self.pieces(" " + segment)

    def decode(self, ids: Iterable[int]) -> bytes:
        vocab = self.vocab
        return b"".join([vocab[i] for i in ids])

    def decode_decimal(self, joined: bytes) -> bytes:
        return b"".join(map(self.decimal.__getitem__, joined.split()))


#: White space as the pattern has it.
WS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_odd = re.compile(rf"[{WS}] [{WS}]").search
_plain = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([.,;:!?*%$#&|]*)").fullmatch
_runs = re.compile(rf"[{WS}]*[^{WS}]+|[{WS}]+").findall


def segments(text: str) -> tuple[list[str], list[str]]:
    """(segments as they stand, segments that follow a space that is left out).

    Both cuts are boundaries of the pattern in any context: a match that holds a
    character that isn't white space never runs on over a white-space character,
    and of a white-space run only the last character can join what follows.
    Where white space stands before or after a single space, the text is cut
    before whole runs instead.
    """
    if "  " in text or text.endswith(" ") or _odd(text):
        return _runs(text), []
    parts = text.split(" ")
    first = parts.pop(0)
    return ([first] if first else []), parts


def replayer(path: str, pattern: str) -> MergeReplay:
    return held(("merge_replay", path, pattern), lambda: MergeReplay(read_ranks(path), pattern))


OUTPUTS = {"n_tokens": "long", "ids": "array<int>", "decoded": "binary", "ids_sha256": "string", "decoded_sha256": "string"}


def encode_documents(
    df: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded"),
) -> DataFrame:
    """One row per input row: the id column and ``outputs`` (keys of ``OUTPUTS``).

    ``decoded`` and ``decoded_sha256`` come from decoding the ids, not from the text.
    Map only: no shuffle, whatever the sizes of sources or groups of copies.
    """
    asked = tuple(outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = replayer(path, pattern)
        kinds = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32()), "decoded": pa.binary(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
        for batch in (s for b in batches for s in slices(b, 1, BATCH_BYTES)):
            joined = bpe.encode_batch(batch.column(1).to_pylist())
            cols: dict[str, list] = {k: [] for k in asked}
            for s in joined:
                raw = bpe.decode_decimal(s) if "decoded" in cols or "decoded_sha256" in cols else b""
                for k, v in cols.items():
                    if k == "n_tokens":
                        v.append(s.count(b" ") + 1 if s else 0)
                    elif k == "ids":
                        continue
                    elif k == "decoded":
                        v.append(raw)
                    elif k == "ids_sha256":
                        v.append(hashlib.sha256(s).hexdigest())
                    else:
                        v.append(hashlib.sha256(raw).hexdigest())
            made = {k: pa.array(v, kinds[k]) for k, v in cols.items() if k != "ids"}
            if "ids" in cols:
                ends = np.cumsum([0, *(s.count(b" ") + 1 if s else 0 for s in joined)])
                flat = np.array(b" ".join(filter(None, joined)).split(), dtype="S8").astype(np.int32)
                made["ids"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(made[k] for k in cols)], names=["id", *cols])
        bpe.forget()
        trim()

    kind = df.schema[id_col].dataType.simpleString()
    schema = ", ".join([f"id {kind}", *(f"{k} {OUTPUTS[k]}" for k in asked)])
    read = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return read.mapInArrow(run, schema).withColumnRenamed("id", id_col)

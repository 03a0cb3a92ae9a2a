"""Token counts of whole texts, huge ones by overlap resynchronisation.

A text of up to ``huge`` characters is counted by the library over segments whose
cuts are boundaries of the split pattern in any context; a bounded memo holds the
counts of segments. A longer text is encoded in overlapping chunks with offsets, so
that no call grows with the text. Neighbouring chunks are spliced at a common stable
boundary: a place in the overlap where both begin a token, where white space follows a
character that is none (there the pattern always cuts, whatever stands around), and
from which both give the same tokens up to the last such place of the overlap. Where
there is none, the overlap is widened, at last over the whole text.

Defined results: a null or empty text has 0 tokens; strings of special tokens inside
texts count as the library handles them by default; null ids and repeated rows pass
through row by row; extra columns are not read. Map only, no shuffle.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagerlens.llm import _library
from wagerlens.llm._io import held, slices
from wagerlens.llm.merge_replay import WS, segments

#: Characters of a text above which it is encoded in chunks.
HUGE = 8_192
CHUNK = 8_192
OVERLAP = 256

_stable = re.compile(rf"(?<=[^{WS}])[ \t\n\r]").finditer


class Counter:
    """Counts tokens as the tokenizer of a .json file gives them."""

    def __init__(self, path: str, separator: str):
        self.tokenizer = _library.load(path)
        self.separator = separator
        self.memo: dict[str, int] = {}

    def count(self, texts: list[str | None], huge: int = HUGE) -> list[int]:
        if len(self.memo) > _library.MEMO:
            self.memo = {}
        memo, out, waiting, new = self.memo, [], [], set()
        for text in texts:
            if not text:
                out.append(0)
            elif len(text) > huge:
                out.append(self.count_huge(text))
            elif "<|" in text:  # may hold a special token's string
                out.append(len(self.tokenizer.encode(text, add_special_tokens=False).ids))
            else:
                head, tail = segments(text)
                got = list(map(memo.get, tail))
                alone = sum(len(e.ids) for e in self.tokenizer.encode_batch_fast(head, add_special_tokens=False)) if head else 0
                if None in got:
                    new.update([s for s, v in zip(tail, got, strict=True) if v is None])
                    waiting.append((len(out), tail))
                    out.append(alone)
                else:
                    out.append(alone + sum(got))
        self._learn(new)
        for i, tail in waiting:
            out[i] += sum(map(memo.__getitem__, tail))
        return out

    def _learn(self, new: set[str]) -> None:
        """Counts of a space and the segment."""
        parts = {s: _library.stem_and_marks(s) if s and not s[0].isspace() else (s, "") for s in new}
        todo = {" " + stem for stem, _ in parts.values()} | {marks for _, marks in parts.values() if marks}
        order = [t for t in todo if t[0] != " " or t[1:] not in self.memo]
        found = dict(zip(order, map(len, _library.encode_apart(self.tokenizer, self.separator, order)), strict=True))
        for s, (stem, marks) in parts.items():
            n = found.get(" " + stem)
            n = self.memo[stem] if n is None else n
            self.memo[s] = n + (found[marks] if marks else 0)
        for t, n in found.items():
            if t[0] == " ":
                self.memo[t[1:]] = n

    def _chunk(self, text: str, lo: int, hi: int) -> tuple[list[int], list[int]]:
        e = self.tokenizer.encode(text[lo:hi], add_special_tokens=False)
        return [lo + a for a, _ in e.offsets], e.ids

    def count_huge(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        """Tokens of a text of any length, from spliced chunks."""
        total, lo, begin = 0, 0, 0  # tokens before begin are counted; the chunk starts at lo <= begin
        starts, ids = self._chunk(text, 0, min(len(text), chunk))
        hi = min(len(text), chunk)
        while hi < len(text):
            wide = overlap
            while True:
                nlo = max(begin, hi - wide)
                nhi = min(len(text), nlo + max(chunk, 2 * wide))
                nstarts, nids = self._chunk(text, nlo, nhi)
                at = self._splice(text, (starts, ids), (nstarts, nids), max(nlo, begin), hi)
                if at is not None:
                    break
                if nlo == begin:  # the overlap spans all that is open: go on with one longer chunk
                    hi = min(len(text), hi + max(chunk, hi - begin))
                    starts, ids = self._chunk(text, begin, hi)
                    if hi == len(text):
                        break
                wide *= 2
            if at is None:
                break
            total += bisect_left(starts, at) - bisect_left(starts, begin)
            begin, starts, ids, hi = at, nstarts, nids, nhi
        return total + len(starts) - bisect_left(starts, begin)

    def _splice(self, text: str, left: tuple[list[int], list[int]], right: tuple[list[int], list[int]], lo: int, hi: int) -> int | None:
        """The first stable boundary in the overlap from which both sides agree."""
        places = [m.start() for m in _stable(text, lo, hi)]
        (ls, li), (rs, ri) = left, right
        if len(places) < 2:
            return None
        last = places[-1]
        le, re_ = bisect_left(ls, last), bisect_left(rs, last)
        for at in places[:-1]:
            if at <= lo:
                continue
            a, b = bisect_left(ls, at), bisect_left(rs, at)
            if a < len(ls) and b < len(rs) and ls[a] == at == rs[b] and li[a:le] == ri[b:re_] and ls[a:le] == rs[b:re_]:
                return at
        return None


def counter(path: str, separator: str) -> Counter:
    return held(("token_count", path, separator), lambda: Counter(path, separator))


def count_tokens(
    df: DataFrame, path: str, limit: int = 1024, separator: str = "<|endoftext|>", id_col: str = "doc_id", text_col: str = "text", huge: int = HUGE
) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(path, separator)
        for batch in (s for b in batches for s in slices(b, 1, _library.BATCH_BYTES)):
            counts = tokens.count(batch.column(1).to_pylist(), huge)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    text = F.col(text_col).cast("string")
    read = df.select(F.col(id_col).alias("id"), text.alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    kind = df.schema[id_col].dataType.simpleString()
    counted = read.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

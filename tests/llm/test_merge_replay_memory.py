"""Memory of a worker that encodes long batches."""

import random
import tracemalloc

import pyarrow as pa

from wagerlens.llm import merge_replay
from wagerlens.llm._io import slices


def test_memory_follows_the_slice_not_the_batch():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"cd": 257}
    bpe = merge_replay.MergeReplay(ranks, r"\s?\S+|\s+")
    r = random.Random(3)
    words = ["".join(r.choices("abcdefgh", k=6)) for _ in range(3_000)]
    texts = [" ".join(r.choices(words, k=6_000)) for _ in range(90)]  # 3.8 MB
    batch = pa.RecordBatch.from_arrays([pa.array(range(90)), pa.array(texts)], names=["id", "text"])
    tracemalloc.start()
    try:
        n = sum(len(bpe.encode_batch(s.column(1).to_pylist())) for s in slices(batch, 1, merge_replay.BATCH_BYTES))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 90
    assert peak < 30e6, peak

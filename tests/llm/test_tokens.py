import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from wagerlens.llm.token_count import Counter, count_tokens
from wagerlens.llm.token_shards import PerfectHash, Shard, WordEncoder, fingerprint, lookup, read_back, token_shards, without_id, write_shards
from wagerlens.llm._io import new_path

WORDS = P.path("word_bpe_49k.json")
BYTES = P.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, start string, n_tokens int"
PARTS = ["a", "ab", "  ", " ", "\n", "\t", "é", "'s", "'", "1", "23", "!", "aaa", "the", "ing", "日本", "\U0001f600", "\x1c", "\xa0", "<|endoftext|>", "ZZ", "the,", "J̌", "İ", "́.", "Σ", "end.", "*** "]


def odd_texts(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 25))) for _ in range(n)]


def test_perfect_hash_is_minimal_and_turns_foreign_keys_away():
    rnd = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 1000, 50_000):
        keys = np.unique(rnd.integers(-(2**62), 2**62, n))
        ph = PerfectHash.build(keys)
        assert sorted(ph.slots(keys)) == list(range(len(keys)))
    prints = np.empty(len(keys), dtype="<u4")
    prints[ph.slots(keys)] = fingerprint(keys)
    foreign = np.setdiff1d(rnd.integers(-(2**62), 2**62, 20_000), keys)
    slot = ph.slots(foreign)
    assert ((slot >= 0) & (prints[slot] == fingerprint(foreign))).sum() == 0


def test_shards_round_trip(spark):
    library = Tokenizer.from_file(WORDS)
    texts = [None, "", "x" * 4000, "The cat, the CAT. " * 9000, *odd_texts(1500, 3)]
    rows = [(i * 3 - 50, t, "s", 1) for i, t in enumerate(texts)]
    rows += [(rows[9][0], "another text of the same id", None, None), rows[10], (None, "no id", "s", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    want, start = [], 0
    for i, t, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(token_shards(df, WORDS, 1).collect(), key=lambda r: r.start) == want
    # small shards, and keyed access
    manifest = write_shards(df, new_path(spark, "t"), WORDS, 1, shard_ids=2000)
    assert len(manifest) > 1
    assert sorted(read_back(df, manifest).collect(), key=lambda r: r.start) == want
    # a few keys over all shards, of which one has two records and one stands nowhere
    asked = spark.createDataFrame([(-50,), (rows[9][0],), (10**9,), (None,), (-50,), (1111,)], "k long")
    got = sorted(lookup(asked, manifest, "k").collect(), key=lambda r: r.start)
    assert [tuple(r)[:4] for r in got] == [w for w in want if w[0] in (-50, rows[9][0], 1111)]
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)
    assert [tuple(r)[:4] for r in without_id(spark, manifest).collect()] == [w for w in want if w[0] is None]
    # keys aren't stored: foreign ones are turned away by their fingerprints
    assert all((Shard(m["base"]).find(np.arange(10**7, 10**7 + 5000))[1] == 0).all() for m in manifest)
    assert token_shards(spark.createDataFrame([], SCHEMA), WORDS).count() == 0


def test_plain_words_and_marks_after_any_letter_equal_the_library():
    library, encoder = Tokenizer.from_file(WORDS), WordEncoder(WORDS, "<|startoftext|>")
    letters = [chr(c) for c in range(0x41, 0x250) if chr(c).isalpha()]
    texts = [f"{x}{m} a{x}{m} {x}b{x}" for x in letters for m in ("!", "***", ".,")] + [" ".join(letters), "ß ÿ ÷ × the cat", *odd_texts(800, 9)]
    for t, raw in zip(texts, encoder.encode(texts), strict=True):
        assert raw == np.array(library.encode(t, add_special_tokens=False).ids, dtype=encoder.kind).tobytes(), t


def test_counts_equal_the_library(spark):
    library = Tokenizer.from_file(BYTES)
    texts = [None, "", "x" * 3000, "The cat, the CAT. " * 500, *odd_texts(3000, 4)]
    df = spark.createDataFrame([(i if i else None, t, "s", 5) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r for r in count_tokens(df, BYTES, limit=20, huge=150).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        r = got[i if i else None]
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((t or "").encode()), n, n > 20), repr(t)
    assert count_tokens(spark.createDataFrame([], SCHEMA), BYTES).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_resynchronised_chunks_equal_one_call(seed):
    library, c, rnd = Tokenizer.from_file(BYTES), Counter(BYTES, "<|endoftext|>"), random.Random(seed)
    text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 3000))) + ("q" * 900 + " " * 700) * (seed % 2) + "".join(odd_texts(60, seed))
    for chunk, overlap in ((50, 10), (200, 30), (1000, 4), (10, 2)):
        assert c.count_huge(text, chunk, overlap) == len(library.encode(text, add_special_tokens=False).ids)

import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from wagerlens.llm.merge_replay import encode_documents, read_ranks, replayer

PATH = P.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, ids string, n_tokens int"


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(PATH), special_tokens={})


def test_equals_the_library_on_odd_texts(library):
    rnd = random.Random(2)
    parts = ["a", "ab", "  ", " ", "\n", "\t", "é", "'s", "'", "1", "23", "!", "aaa", "the", "ing", "日本", "\U0001f600", "\x1c", " ", "<|endoftext|>", "ZZ", "the,"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(4000)]
    texts += ["", None, "x" * 3000, "ab" * 1500 + " tail", "aab" * 999, " ".join(["word"] * 3000)]
    for text, got in zip(texts, replayer(PATH, P.PATTERN).encode_batch(texts), strict=True):
        assert [int(x) for x in got.split()] == library.encode_ordinary(text or ""), text


def test_rows(spark, library):
    rows = [(1, "The cat sat.", "x", 3), (2, None, None, None), (None, "", "y", 1), (1, "The cat sat.", "x", 3), (3, "a b" * 100_000, None, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = encode_documents(df, PATH, P.PATTERN, outputs=("n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256")).collect()
    assert len(got) == 5
    for r in got:
        text = next(t for i, t, *_ in rows if i == r.doc_id) or ""
        ids = library.encode_ordinary(text)
        assert r.ids == ids and r.n_tokens == len(ids) and bytes(r.decoded) == text.encode()
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert encode_documents(spark.createDataFrame([], SCHEMA), PATH, P.PATTERN).count() == 0


def test_a_long_word_takes_little_time():
    text = "a" * 200_000 + "bc" * 100_000
    bpe = replayer(PATH, P.PATTERN)
    assert bpe.decode_decimal(bpe.encode_batch([text])[0]) == text.encode()

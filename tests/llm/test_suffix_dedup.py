import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from wagerlens.llm import bwt, suffix_dedup
from wagerlens.llm.suffix_dedup import _buffers, remove_repeats, runs, whole_characters

SCHEMA = "doc_id long, text string, start string, key long, ord int"


def brute(rows, length=100):
    """(id, n_bytes, n_removed, n_spans, kept hash) by a set of all strings seen."""
    seen, out = set(), []
    for i, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, dtype=np.int8)
        for s in range(len(raw) - length + 1):
            w = raw[s : s + length]
            if w in seen:
                gone[s : s + length] = 1
            seen.add(w)
        spans = int((np.diff(np.r_[0, gone[:-1], 0]) == 1).sum())
        kept = bytes(b for b, g in zip(raw, gone, strict=False) if not g)
        out.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_merged_transforms_equal_plain_grouping():
    for seed in range(120):
        r = random.Random(seed)
        length = r.choice([1, 2, 3, 5])
        strings = [bytes(r.choice(b"ab\0\xff") for _ in range(r.randint(0, 12))) for _ in range(r.randint(1, 12))]
        got, want = defaultdict(set), defaultdict(set)
        for x, y, z in zip(*(v.tolist() for v in bwt.repeated(strings, length, r.choice([5, 20, 1000]))), strict=True):
            got[z].add((x, y))
        for step in (1, 3):  # symbols of a round
            again = defaultdict(set)
            for x, y, z in zip(*(v.tolist() for v in bwt.repeated(strings, length, 20, step)), strict=True):
                again[z].add((x, y))
            assert sorted(map(sorted, again.values())) == sorted(map(sorted, got.values()))
        for i, t in enumerate(strings):
            for k in range(len(t) - length + 1):
                want[t[k : k + length]].add((i, k))
        assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_common_prefixes():
    strings = [b"banana", b"bandana", b"ana", b"nab"]
    made = [bwt.collection([s]) for s in strings]
    orders = [bwt.suffix_array(*m) for m in made]
    z, _, prefix = bwt.merge([bwt.transform(m[0], o) for m, o in zip(made, orders, strict=True)], 10)
    at = [0] * 4
    merged = []
    for k in z.tolist():
        merged.append(strings[k][orders[k][at[k]] :])
        at[k] += 1
    assert merged[4:] == sorted(merged[4:])
    for a, b, p in zip(merged, merged[1:], prefix[1:].tolist(), strict=False):
        common = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert p == common


def test_equal_windows_have_equal_anchors():
    r = np.random.default_rng(3)
    core = r.integers(97, 100, 300, dtype=np.uint8)
    docs = [np.r_[r.integers(97, 123, k, dtype=np.uint8), core, r.integers(97, 123, 50, dtype=np.uint8)] for k in (0, 7, 333)]
    raw = np.concatenate(docs)
    starts = np.cumsum([0, *map(len, docs)])
    found = runs(raw, starts, 100)
    anchors = defaultdict(set)
    total = 0
    for d, s, w, a, key in zip(*(found[k].tolist() for k in ("doc", "start", "windows", "anchor", "key")), strict=True):
        for p in range(s, s + w):
            total += 1
            assert p <= a <= p + 68
            anchors[docs[d][p : p + 100].tobytes()].add((a - p, key))
    assert total == sum(len(d) - 99 for d in docs)
    assert all(len(v) == 1 for v in anchors.values())


@pytest.mark.parametrize(("seed", "most"), [(0, 10**6), (1, 10**6), (2, 3), (3, 1)])
def test_equals_brute_force(spark, monkeypatch, seed, most):
    monkeypatch.setattr(suffix_dedup, "GROUP_MOST", most)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", most % 1000 + 7)  # groups cross the edges of batches
    r = random.Random(seed)
    alphabet = ["a", "b", "é", "日", " ", "\0"][: r.choice([2, 4, 6])]

    def noise(n):
        return "".join(r.choice(alphabet) for _ in range(n))

    passages = [noise(r.choice([99, 100, 101, 130, 400])) for _ in range(8)]
    rows = []
    for k in range(120):
        parts = [r.choice([noise(r.randint(0, 250)), r.choice(passages), r.choice(passages)[r.randint(0, 60) :]]) for _ in range(r.randint(0, 5))]
        text = "".join(parts)
        if rows and k % 5 == 0:
            text = r.choice(rows)[1] or ""
            cut = r.randint(0, len(text))
            text = text[:cut] + r.choice(["", "x", "yy"]) + text[cut + r.randint(0, 2) :]
        rows.append((1000 - 7 * k, text))
    rows += [(5, None), (6, ""), (7, "z" * 5000), (8, "ab" * 900), (2, "q" * 99), (3, "q" * 100), (4, "q" * 100)]
    want = sorted(brute(sorted(rows)))
    df = spark.createDataFrame([(i, t, "s", 1, 2) for i, t in r.sample(rows, len(rows))], SCHEMA)
    got = remove_repeats(df, outputs=("n_bytes", "n_removed", "n_spans", "kept_sha256")).collect()
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(tuple(x) for x in got) == want


def test_what_repeats_once_is_found_by_the_merged_transforms_alone(spark):
    r = random.Random(7)
    texts = ["".join(r.choice("abcdef ") for _ in range(r.randint(150, 900))) for _ in range(40)]
    rows = [(k, t) for k, t in enumerate([*texts, *texts[:20], *(t[60:] + "end" for t in texts[20:])])]
    docs = spark.createDataFrame(rows, "ord long, text string")
    met = suffix_dedup._met(suffix_dedup._described(docs, 100), 100)
    assert met.filter("key is null and ord1 is null").count() == 0  # hashes settle nothing here
    got = remove_repeats(docs.withColumnRenamed("ord", "doc_id"), outputs=("n_bytes", "n_removed", "n_spans", "kept_sha256")).collect()
    assert sorted(tuple(x) for x in got) == brute(rows) and sum(x.n_removed for x in got) > 10_000


def test_null_and_repeated_ids_and_an_empty_table(spark):
    long = "".join(chr(97 + (k * k + k // 7) % 26) for k in range(150))
    rows = [(None, long, "s", 1, 1), (4, long, "s", 1, 1), (4, long, "s", 1, 1), (2, "other " + long, "s", 1, 1)]
    got = sorted((str(x.doc_id), x.n_removed, x.n_spans) for x in remove_repeats(spark.createDataFrame(rows, SCHEMA), outputs=("n_removed", "n_spans")).collect())
    assert got == [("2", 150, 1), ("4", 150, 1), ("4", 150, 1), ("None", 0, 0)]
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_whole_characters():
    raw = "aéb日c".encode()
    assert whole_characters(raw, [(2, 4)]) == "aé日c"
    assert whole_characters(raw, [(1, 5)]) == "a日c"
    assert whole_characters(raw, []) == "aéb日c"
    assert whole_characters(raw, [(0, len(raw))]) == ""


def test_long_texts_are_cut_into_stretches_that_hold_every_window_once():
    texts = [b"x" * 5, b"0123456789" * 100, b"", b"y" * 64, b"z" * 129]
    seen = []
    for raw, starts, index, base in _buffers(texts, 10, most=64):
        assert len(raw) <= 64 + 9
        for k, (i, at) in enumerate(zip(index.tolist(), base.tolist(), strict=True)):
            part = raw[starts[k] : starts[k + 1]].tobytes()
            assert texts[i][at : at + len(part)] == part
            seen += [(i, at + p) for p in range(len(part) - 9)]
    assert sorted(seen) == [(i, p) for i, t in enumerate(texts) for p in range(len(t) - 9)]

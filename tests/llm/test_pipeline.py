"""The pipeline against plain code on a small fixture, and what is registered."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers as P
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from wagerlens.llm import lang_id
from wagerlens.llm.merge_replay import read_ranks
from wagerlens.llm.suffix_dedup import whole_characters

from test_learned import plain_probabilities

EN = "the and of to in that is was for with as his on be at by this had not are but from they which one you were all her she"
DE = "der die und das nicht von sie ist des sich mit dem dass er es ein ich auf so eine auch als an nach wie im fuer man aber aus"


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def brute(spark, rows, items):
    # 1: the trained network over whole texts, byte by byte
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    net = lang_id.learn(docs, F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) != 2)
    kept = []
    for r in rows:
        if r[1] and re.search(r"[^\W\d_]", r[1]):
            if plain_probabilities(net, r[1].encode(), lang_id.CHUNK, lang_id.CONTEXT).max() >= corpus_pipeline.least_language(len(net.labels)):
                kept.append(r)
    # 2: components of all pairs
    rows, root = kept, {}
    sets = {r[0]: shingles(r[1], 5) for r in rows}
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(i):
        return i if root[i] == i else find(root[i])

    for k, x in enumerate(ids):
        for y in ids[k + 1 :]:
            both = len(sets[x] & sets[y])
            if both and 100 * both >= 80 * (len(sets[x]) + len(sets[y]) - both):
                a, b = sorted((find(x), find(y)))
                root[b] = a
    rows = sorted(r for r in rows if find(r[0]) == r[0])
    # 3: strings of 100 bytes seen before
    seen, cut = set(), []
    for r in rows:
        raw, gone = r[1].encode(), []
        for s in range(len(raw) - 99):
            if raw[s : s + 100] in seen:
                gone.append((s, s + 100))
            seen.add(raw[s : s + 100])
        spans = []
        for s, e in gone:
            if spans and s <= spans[-1][1]:
                spans[-1] = (spans[-1][0], e)
            else:
                spans.append((s, e))
        cut.append((r[0], whole_characters(raw, spans)))
    # 4: 11 of 13 tokens of an item, place by place
    def tokens(t):
        return [w for w in re.split(r"[\W_]+", t.lower()) if w]

    clean = []
    for i, t in cut:
        x, bad = np.array([*tokens(t), *["\0"] * 13]), False
        for _, u in items:
            y = np.array(tokens(u))
            for a in range(len(y) - 12):
                bad = bad or any((x[b : b + 13] == y[a : a + 13]).sum() >= 11 for b in range(len(x) - 25))
        if not bad:
            clean.append((i, t))
    # 5: the library
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    return [(i, ids := library.encode_ordinary(t), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for i, t in clean]


def test_pipeline_equals_brute_force(spark, tmp_path):
    r = random.Random(3)

    def prose(n, words):
        return " ".join(r.choice(words) + r.choice(["", "", f"{r.randint(0, 99)}x", "é"]) for _ in range(n))

    passage, items = prose(30, EN.split()), [(k, prose(24, EN.split())) for k in range(6)]
    rows = []
    for i in range(90):
        text = prose(r.choice([3, 30, 80]), (EN if i % 3 else DE).split())
        if i % 7 == 0:
            text += " " + passage + " " + prose(20, EN.split())
        if i % 11 == 0:
            leak = items[i % 6][1].split()
            leak[5] = "changed"
            text = prose(9, EN.split()) + " " + " ".join(leak) + " end"
        rows.append((i, text, "en" if i % 3 else "de", "s", len(text)))
    for i in range(90, 110):
        old = rows[r.randrange(60)]
        words = old[1].split()
        words[r.randrange(len(words))] = "edited"
        rows.append((i, " ".join(words) if i % 2 else old[1], old[2], "s", 0))
    rows += [(200, None, "en", "s", 0), (201, "", "en", "s", 0), (202, "123 ...", "de", "s", 7)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = brute(spark, rows, items)
    assert sorted((x.doc_id, list(x.ids), x.ids_sha256, x.decoded_sha256) for x in got) == sorted(want)
    assert 20 < len(want) < 100


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "suffix_dedup", "decontamination", "byte_level_bpe"]


def test_all_are_registered():
    import __spark_entry__ as entry

    names = {n.split("_")[0] for n in entry.queries()}
    assert {f"op{k}" for k in range(1, 11)} <= names and "pipeline" in names

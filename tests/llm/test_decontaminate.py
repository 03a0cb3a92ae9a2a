import random
import re

import pytest

from wagerlens.llm import decontaminate as D

DOCS = "doc_id long, text string, item_id string, seed long"
ITEMS = "item_id long, text string, tokens string"


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def brute(docs, items):
    out = set()
    for d, t, *_ in docs:
        x = words(t)
        for i, u, *_ in items:
            y = words(u)
            for shift in range(-len(y), len(x)):
                pos = [k for k in range(len(y)) if 0 <= k + shift < len(x)]
                agree = [int(y[k] == x[k + shift]) for k in pos]
                wide = min(D.WINDOW, len(y))
                best = max((sum(agree[s : s + wide]) for s in range(len(agree) - wide + 1)), default=0)
                if y and len(agree) >= wide and best >= -(-wide * 8 // 10):
                    out.add((d, i))
    return out


@pytest.fixture(scope="module")
def tables():
    rnd = random.Random(8)
    vocabulary = [f"v{k}" for k in range(60)] + ["é", "The", "of", "of", "the"]
    items = [(k, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([4, 9, 12, 30, 50]))) + ".", "z") for k in range(30)]
    docs = []
    for k in range(160):
        t = [rnd.choice(vocabulary) for _ in range(rnd.choice([0, 5, 40, 120]))]
        if k % 2:
            passage = rnd.choice(items)[1].split()
            cut = rnd.randrange(max(1, len(passage) - 14))
            passage = passage[cut : cut + rnd.choice([8, 14, 60])]
            for _ in range(rnd.choice([0, 1, 2, 5])):
                passage[rnd.randrange(len(passage))] = "changed"
            at = rnd.randrange(len(t) + 1)
            t[at:at] = passage
        docs.append((k, rnd.choice([" ", ", ", "\n"]).join(t), "q", 1))
    docs += [(500, None, "q", 1), (None, items[5][1] + " and " + items[6][1], "q", 1), (501, "", "q", 2), (3, docs[3][1], "q", 1), (502, "word " * 30_000 + items[3][1], "", 1)]
    items += [(90, None, ""), (91, "", "z"), (None, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10", "z")]
    return docs, items


@pytest.mark.parametrize("most", [10**6, 0])
def test_pairs_equal_brute_force(spark, tables, monkeypatch, most):
    monkeypatch.setattr(D, "BROADCAST_SEEDS", most)
    docs, items = tables
    got = D.pairs(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), short=True).collect()
    found = [(r.doc_id, r.item_id) for r in got]
    assert len(found) == len(set(found))
    assert set(found) == brute(docs[:-1], items) | {(502, 3)}


def test_clean_rows_stay(spark, tables):
    docs, items = tables
    docs = [*docs, (1, "a row of the same id that is clean", "q", 1), (None, "also clean", "q", 7)]
    bad = brute(docs[: -3], items)
    left = D.clean(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), short=True)
    assert left.columns == ["doc_id", "text", "item_id", "seed"]
    got = sorted((tuple(r) for r in left.collect()), key=str)
    hit = {(i, t) for i, t, *_ in docs if i != 502 and any(d == i for d, _ in bad)} - {(1, docs[-2][1]), (None, "also clean")}
    assert [r for r in got if r[0] != 502] == sorted([r for r in docs if r[0] != 502 and (r[0], r[1]) not in hit], key=str)


def test_columns_of_any_name_stay(spark, tables):
    rows = spark.createDataFrame([(1, "clean", "own", 5)], "doc_id long, text string, __hash string, __id long")
    left = D.clean(rows, spark.createDataFrame(tables[1], ITEMS), short=True)
    assert left.columns == rows.columns and left.first() == rows.first()


def test_empty_tables(spark, tables):
    docs, items = tables
    assert D.pairs(spark.createDataFrame([], DOCS), spark.createDataFrame(items, ITEMS)).count() == 0
    assert D.pairs(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], ITEMS)).count() == 0
    assert D.clean(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], ITEMS)).count() == len(docs)


def test_masks_meet_any_two_substitutions_in_thirteen():
    from itertools import combinations

    for lost in combinations(range(13), 2):
        kept = set(range(13)) - set(lost)
        assert any(all(s + o in kept for o in mask) for s in range(13 - D.SPAN + 1) for mask in D.MASKS)

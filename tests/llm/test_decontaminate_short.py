"""Items shorter than a window: whatever verification accepts is found."""

from itertools import combinations

import pytest

from wagerlens.llm import decontaminate as D

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


@pytest.mark.parametrize("length", range(1, 13))
def test_masks_meet_every_accepted_pattern(length):
    lost = length - -(-length * 8 // 10)
    masks = D.short_masks(length, D.SHARE)
    assert all(masks)
    for gone in combinations(range(length), lost):
        assert any(not set(gone) & set(mask) for mask in masks)


def test_short_items_equal_brute_force(spark):
    items = [(n, " ".join(f"i{n}w{k}" for k in range(n))) for n in range(1, 15)] + [(90, None), (91, "")]
    docs, want = [], set()
    for n in range(1, 13):
        words = items[n - 1][1].split()
        for lost in range(4):
            for gone in combinations(range(n), lost):
                x = ["x" if k in gone else w for k, w in enumerate(words)]
                for y in (x, ["before", *x, "after", "that"]):
                    if 5 * (n - lost) >= 4 * n:
                        want.add((len(docs), n))
                    docs.append((len(docs), " ".join(y)))
    docs += [(-1, None), (-2, "")]
    got = D.pairs(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), short=True).collect()
    assert len(got) == len(want) and {(r.doc_id, r.item_id) for r in got} == want

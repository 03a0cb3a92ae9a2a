"""Benchmark decontamination by spaced seeds, with DataFrame functions only.

A seed is a fixed mask over a stretch of ``SPAN`` tokens; positions it leaves out may
differ. Every stretch of a test item and of a document is hashed under every mask, and
equal hashes are joined. A hit fixes how item and document lie on each other, and the
overlap of the two along that diagonal is verified: within some window of ``window``
item tokens (all of them, where an item has fewer) at least ``share`` of the tokens must
be equal, place by place. So substitutions are tolerated, both by the masks and by
the verification, and a chance hit is turned away. The two masks are chosen so that
any 13 tokens of which at most 2 were substituted hold a hit, wherever they were
(checked over all 78 cases in the tests): with the defaults nothing that the
verification accepts in a window of 13 can be missed.

An item of fewer tokens than a window is verified as a whole. With ``short`` it has masks
over its whole length: the places are dealt into two groups more than the substitutions
that verification accepts, and there is a mask without each choice of so many groups, so
one of the masks meets whatever is accepted. Items of up to 4 tokens are found verbatim
only. Documents are hashed for the short lengths that the test set has. Without ``short``
such items are searched by the two masks alone, from ``SPAN`` tokens on.

The test set is small next to the corpus. Its hashes are broadcast only if their
number, counted first, is within ``BROADCAST_SEEDS``; beyond that the join shuffles.
The search carries ids and places, never texts. The distinct hits are written, so
that their size decides whether the texts of documents with hits are fetched by a
broadcast or by a shuffled join; only those texts are read again for verification.

Tokens are runs of letters and digits, lower-cased. Defined results: null and empty
texts have no tokens and no hits; nor have documents shorter than the item's seeds; rows with a null document id are reported under a
null id; repeated rows count once in ``pairs``; an empty table on either side gives none;
extra columns aren't read by ``pairs`` and, whatever their names, passed on by ``clean``.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagerlens.llm._io import stage

#: Tokens that a seed spans, and the offsets that each mask compares.
SPAN = 9
MASKS = ((0, 1, 2, 5, 7, 8), (0, 2, 3, 4, 7, 8))
#: Hashes of the test set that may be broadcast (about 40 bytes each).
BROADCAST_SEEDS = 1_000_000
WINDOW = 13
SHARE = 0.8


def tokens(text: Column) -> Column:
    """Runs of letters and digits, lower-cased; one empty token where there are none."""
    return F.split(F.trim(F.regexp_replace(F.lower(text.cast("string")), r"[^\p{L}\p{N}]+", " ")), " ")


def short_masks(length: int, share: float) -> tuple[tuple[int, ...], ...]:
    """Masks over ``length`` tokens of which one meets any ``share`` of them that are equal."""
    lost = length - math.ceil(share * length)
    groups = min(length, lost + 2)
    return tuple(tuple(o for o in range(length) if o % groups not in out) for out in combinations(range(groups), lost))


#: Span, mask and the numbers that tell its hashes from others.
_LONG = [(SPAN, mask, (k,)) for k, mask in enumerate(MASKS)]


def _seeds(df: DataFrame, keep: list[str], masks: list[tuple[int, tuple[int, ...], tuple[int, ...]]] = _LONG) -> DataFrame:
    """A row for every stretch and mask of ``tokens``: ``keep``, ``at`` and ``seed``.

    Shifted slices are zipped, so that a row holds the tokens of one stretch and never
    the document: memory and time stay linear in its length.
    """
    offsets = sorted({o for span, mask, _ in masks for o in (*mask, span - 1)})
    least = min(span for span, _, _ in masks)
    count = F.size("tokens") - least + 1
    zipped = F.arrays_zip(*(F.slice("tokens", o + 1, count).alias(f"t{o}") for o in offsets))
    fits = df.filter(F.size("tokens") >= least)
    at = fits.select(*keep, F.posexplode(zipped).alias("at", "t"))

    def seed(span: int, mask: tuple[int, ...], name: tuple[int, ...]) -> Column:
        value = F.xxhash64(*map(F.lit, name), *(F.col("t").getField(f"t{o}") for o in mask))
        # past the end of the document a longer stretch is padded with nulls
        return value if span == least else F.when(F.col("t").getField(f"t{span - 1}").isNotNull(), value)

    return at.select(*keep, "at", F.explode(F.array(*(seed(*m) for m in masks))).alias("seed"))


def _same(left: str, right: str, key: list[str]) -> Column:
    same = F.lit(True)
    for k in key:
        same = same & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return same


def hits(docs: DataFrame, items: DataFrame, key: list[str], text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, share: float = SHARE, short: bool = False) -> DataFrame:
    """``key``, item, doc_at, item_at, overlap, equal, best: verified overlaps.

    ``best`` is the largest number of equal tokens in a window of the overlap.
    """
    size = F.size("tokens")
    searched = (size > 1) | (F.col("tokens")[0] != "") if short else size >= SPAN
    test = stage(items.select(F.col(item_col).alias("item"), tokens(F.col(item_text_col)).alias("tokens")).filter(searched), "test")
    sized = test.withColumn("length", size)
    lengths = sorted(r.length for r in sized.filter(F.col("length") < window).select("length").distinct().collect()) if short else []
    masks = {n: [(n, mask, (n, k)) for k, mask in enumerate(short_masks(n, share))] for n in lengths}
    seeds = _seeds(sized.filter(F.col("length") >= (window if short else SPAN)), ["item", "length"])
    for n in lengths:
        seeds = seeds.union(_seeds(sized.filter(F.col("length") == n), ["item", "length"], masks[n]))
    seeds = stage(seeds.withColumnRenamed("at", "item_at").distinct(), "seeds")
    corpus = _seeds(docs.select(*key, tokens(F.col(text_col)).alias("tokens")), key, _LONG + [m for n in lengths for m in masks[n]])
    met = corpus.join(F.broadcast(seeds) if seeds.count() <= BROADCAST_SEEDS else seeds, "seed")
    lies = met.select(*key, F.struct("item", "length", (F.col("at") - F.col("item_at")).alias("shift")).alias("lie")).distinct()
    lies = stage(lies.groupBy(*key).agg(F.collect_list("lie").alias("lies")), "lies")  # bounded by a document's length
    again = docs.select(*key, tokens(F.col(text_col)).alias("tokens")).alias("d").join(lies.alias("l"), _same("d", "l", key))
    again = stage(again.select(*(F.col(f"d.{k}").alias(k) for k in key), "tokens", "lies"), "met")

    def overlap(lie: Column) -> Column:
        # the stretch of the document that lies on the item
        first = F.greatest(F.lit(0), -lie["shift"])
        last = F.least(lie["length"], F.size("tokens") - lie["shift"])
        return F.struct(lie["item"].alias("item"), lie["length"].alias("length"), (lie["shift"] + first).alias("doc_at"), first.alias("item_at"), F.slice("tokens", lie["shift"] + first + 1, last - first).alias("y"))

    laid = again.select(*key, F.explode(F.transform("lies", overlap)).alias("o")).select(*key, "o.*")
    laid = laid.alias("o").join(test.select("item", F.col("tokens").alias("x")).distinct().alias("t"), F.col("o.item").eqNullSafe(F.col("t.item")) & (F.size("t.x") == F.col("o.length")))
    agree = laid.select(
        *key, "o.item", "doc_at", "item_at", "length", F.zip_with(F.slice("x", F.col("item_at") + 1, F.size("y")), "y", lambda a, b: (a == b).cast("int")).alias("agree")
    )
    wide = F.least(F.lit(window), F.col("length"))
    sums = F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("agree") - wide + 1)),
        lambda i: F.aggregate(F.slice("agree", i, wide), F.lit(0), lambda s, v: s + v),
    )
    found = agree.select(
        *key,
        "item",
        "doc_at",
        "item_at",
        F.size("agree").alias("overlap"),
        F.aggregate("agree", F.lit(0), lambda s, v: s + v).alias("equal"),
        F.array_max(sums).alias("best"),
        wide.alias("wide"),
    )
    return found.filter((F.col("overlap") >= F.col("wide")) & (F.col("best") >= F.ceil(F.lit(share) * F.col("wide")))).drop("wide").distinct()


def pairs(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """id, item_id, best, equal, n_overlaps, doc_at, item_at: one row per contaminated pair.

    The place is that of the best overlap, the first of several equally good ones.
    """
    found = hits(docs, items, [id_col], text_col, **how)
    place = F.max_by(F.struct("doc_at", "item_at"), F.struct("best", "equal", -F.col("doc_at"), -F.col("item_at")))
    out = found.groupBy(id_col, "item").agg(F.max("best").alias("best"), F.max("equal").alias("equal"), F.count("*").alias("n_overlaps"), place.alias("place"))
    return out.select(id_col, F.col("item").alias("item_id"), "best", "equal", "n_overlaps", "place.doc_at", "place.item_at")


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` without a verified overlap with any item.

    Rows are told apart by id and text, so a clean row that shares its id (or has none)
    stays. The contaminated keys are written first: their size then decides the join.
    """
    names = {c.lower() for c in docs.columns}
    mark = "__hash"
    while mark in names:
        mark += "_"
    digest = F.xxhash64(F.col(text_col).cast("string"))
    keys = docs.select(F.col(id_col).alias("__id"), digest.alias("__digest"), F.col(text_col).alias("__text"))
    found = stage(hits(keys, items, ["__id", "__digest"], "__text", **how).select("__id", "__digest").distinct(), "contaminated")
    marked = docs.withColumn(mark, digest)
    same = F.col(f"d.{id_col}").eqNullSafe(F.col("f.__id")) & (F.col(f"d.{mark}") == F.col("f.__digest"))
    return marked.alias("d").join(found.alias("f"), same, "left_anti").select(*docs.columns)

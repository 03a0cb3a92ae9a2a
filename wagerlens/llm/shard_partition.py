"""Minimax contiguous partition of documents into shards.

Equal texts form an atomic group. Groups stand in the order of their smallest
document id; the shards are contiguous runs of groups, and the largest shard is as
small as a contiguous partition allows. That capacity is found by binary search with
a greedy check over the running sums of the group sizes.

The running sums stay distributed. The driver searches over a bounded list of
breakpoints (``RESOLUTION``): stretches of groups, of which a cut may fall anywhere
inside. A greedy check that may cut nowhere inside a stretch bounds the capacity from
above, one that may cut everywhere bounds it from below, and every stretch in which
no cut between the two bounds can fall is settled. The others are read again at finer
resolution until all breakpoints of interest are group ends; each pass shrinks the
open stretches by a factor near ``RESOLUTION / n_shards``.

Defined results: null texts form one group, their size is 1 and their crc32 null; an
empty text has size 1 and crc32 0; rows with a null id come first; repeated rows are
equal texts and count once each; an empty table gives an empty table; extra input
columns are not read. Only DataFrame functions run on the data.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wagerlens.llm._io import stage

#: Breakpoints that the driver holds at once.
RESOLUTION = 65_536
#: Unsettled cells that one pass reads again; the others wait for the next pass.
OPEN = 64


def shard_documents(
    df: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text", resolution: int = RESOLUTION
) -> DataFrame:
    """id, size, text_crc32, law, shard, slot, grown_shard: one row per input row."""
    text = F.col(text_col).cast("string")
    rows = df.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
        F.sha2(text.cast("binary"), 256).alias("digest"),
    )
    rows = stage(rows, "shard-rows")
    lined = _lined_up(_with_first(rows))
    totals = lined.agg(F.max("cum").alias("bytes"), F.count("*").alias("n")).first()
    if not totals["n"]:
        cuts: list[int] = []
    else:
        cuts = minimax_cuts(_GroupEnds(lined, resolution), totals["bytes"], n_shards)
    # the shard of a row: how many cuts lie before the end of its group
    shard = sum((F.col("group_end") > F.lit(c)).cast("int") for c in cuts) if cuts else F.lit(0)
    placed = lined.withColumn("shard", shard)
    first = placed.groupBy("shard").agg(F.min("row").alias("first_row"))
    return placed.join(F.broadcast(first), "shard").select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("row") - F.col("first_row")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _with_first(rows: DataFrame) -> DataFrame:
    """Adds ``first``, the smallest id of the rows with the same text, and ``members``.

    Only digests of repeated texts are joined back, so that a text without a copy
    moves once; hot digests meet one row each, and the adaptive join can split them.
    """
    groups = rows.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("members")).filter("members > 1")
    return rows.join(groups.withColumnRenamed("digest", "key"), F.col("digest").eqNullSafe(F.col("key")), "left").select(
        "id", "size", "crc", F.coalesce("digest", F.lit("")).alias("digest"), F.coalesce("first", "id").alias("first")
    )


def _lined_up(rows: DataFrame) -> DataFrame:
    """Rows in global order with running sums: part, row, cum and group_end.

    Range partitions hold a stretch of the order each, also of one large group; sums
    within a partition and a short list of partition totals give the global ones.
    """
    spark = rows.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = ["first", "digest", "id"]
    ranged = stage(rows.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), "shard-order")
    within = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumns({"row": F.count(F.lit(1)).over(within) - 1, "cum": F.sum("size").over(within)})
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    totals = ranged.groupBy("part").agg(F.count("*").alias("n"), F.sum("size").alias("b"))
    totals = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"), F.coalesce(F.sum("b").over(before), F.lit(0)).alias("bytes_before"))
    summed = local.join(F.broadcast(totals), "part").select(
        "id", "size", "crc", "first", "digest", "part", (F.col("row") + F.col("rows_before")).alias("row"), (F.col("cum") + F.col("bytes_before")).alias("cum")
    )
    # a group's end: within the partition, or further on for the group that crosses its edge
    ends = summed.groupBy("first", "digest").agg(F.max("cum").alias("group_end"), F.count("*").alias("members")).filter("members > 1")
    again = ends.select(F.col("first").alias("f"), F.col("digest").alias("d"), "group_end")
    lined = summed.join(again, F.col("first").eqNullSafe(F.col("f")) & (F.col("digest") == F.col("d")), "left")
    return stage(lined.select("id", "size", "crc", "part", "row", "cum", F.coalesce("group_end", "cum").alias("group_end")), "shard-line")


class _GroupEnds:
    """Ends of groups on the byte line, read at a bounded resolution."""

    def __init__(self, lined: DataFrame, resolution: int):
        self.ends = stage(lined.filter("cum = group_end").select("cum"), "shard-ends")
        self.resolution = resolution

    def read(self, stretches: list[tuple[int, int]]) -> tuple[list[tuple[int, int, int]], bool]:
        """For the group ends in the half-open (lo, hi] ``stretches``: (least, most,
        number) of each cell of a stretch, and whether that names every end."""
        cells = max(1, self.resolution // len(stretches))
        low, width = F.lit(None).cast("long"), F.lit(None).cast("long")
        for lo, hi in stretches:
            inside = (F.col("cum") > lo) & (F.col("cum") <= hi)
            low, width = F.when(inside, F.lit(lo)).otherwise(low), F.when(inside, F.lit(max(1, -(-(hi - lo) // cells)))).otherwise(width)
        found = (
            self.ends.withColumns({"lo": low, "width": width})
            .filter("lo is not null")
            .groupBy("lo", F.floor((F.col("cum") - F.col("lo") - 1) / F.col("width")).alias("cell"))
            .agg(F.min("cum").alias("least"), F.max("cum").alias("most"), F.count("*").alias("n"))
            .select("least", "most", "n")
            .collect()  # at most ``resolution`` rows
        )
        out = sorted((r["least"], r["most"], r["n"]) for r in found)
        return out, all(n <= 2 for _, _, n in out)


def _needed(ends: list[int], total: int, capacity: int, limit: int) -> list[int] | None:
    """Greedy cuts at ``ends`` under ``capacity``; None if over ``limit`` shards are needed."""
    cuts, at = [], 0
    while total - at > capacity:
        k = bisect_right(ends, at + capacity) - 1
        if k < 0 or ends[k] <= at or len(cuts) + 2 > limit:
            return None
        at = ends[k]
        cuts.append(at)
    return cuts


def _least(ends: list[int], total: int, limit: int, low: int, high: int) -> int:
    """Smallest capacity in low..high for which greedy cuts need at most ``limit`` shards."""
    while low < high:
        mid = (low + high) // 2
        if _needed(ends, total, mid, limit) is None:
            low = mid + 1
        else:
            high = mid
    return low


def minimax_cuts(groups, total: int, n_shards: int) -> list[int]:
    """Byte positions of the cuts of the best contiguous partition.

    ``groups.read`` gives cells of group ends. ``fixed`` holds ends that are known
    one by one; an unsettled cell (least, most) may hold ends anywhere between.
    """
    cells, exact = groups.read([(0, total)])
    known = cells
    floor_, ceil_ = -(-total // n_shards), total
    while True:
        known_ends = sorted({e for least, most, _ in known for e in (least, most)})
        upper = _least(known_ends, total, n_shards, floor_, ceil_)
        if exact:
            return _needed(known_ends, total, upper, n_shards)
        # where ends may lie anywhere inside a cell, greedy reaches further: a lower bound
        lower = _least_open(known, total, n_shards, floor_, upper)
        floor_, ceil_ = lower, upper
        near = _reach(known, total, lower, upper)
        stretches = [(least - 1, most) for least, most, n in known if n > 2 and any(lo <= most and least <= hi for lo, hi in near)]
        if not stretches:
            return _needed(known_ends, total, upper, n_shards)
        stretches = stretches[: max(1, min(OPEN, groups.resolution // 4))]
        finer, _ = groups.read(stretches)
        kept = [c for c in known if not any(lo < c[0] and c[1] <= hi for lo, hi in stretches)]
        known = sorted(kept + finer)


def _open_step(cells: list[tuple[int, int, int]], starts: list[int], x: int) -> int:
    """Largest place up to ``x`` where a group may end."""
    k = bisect_right(starts, x) - 1
    if k < 0:
        return -1
    least, most, n = cells[k]
    return min(most, x) if n > 2 else (most if most <= x else least)


def _least_open(cells: list[tuple[int, int, int]], total: int, limit: int, low: int, high: int) -> int:
    starts = [c[0] for c in cells]

    def fits(capacity: int) -> bool:
        at = 0
        for _ in range(limit):
            if total - at <= capacity:
                return True
            nxt = _open_step(cells, starts, at + capacity)
            if nxt <= at:
                return False
            at = nxt
        return total - at <= 0

    while low < high:
        mid = (low + high) // 2
        if fits(mid):
            high = mid
        else:
            low = mid + 1
    return low


def _reach(cells: list[tuple[int, int, int]], total: int, lower: int, upper: int) -> list[tuple[int, int]]:
    """For each cut, the interval in which greedy cuts under any capacity in lower..upper fall.

    The least place of cut i: at least the last sure end within ``lower`` of the least
    place before; the largest: the furthest possible end within ``upper``.
    """
    starts = [c[0] for c in cells]
    sure = sorted({e for c in cells for e in (c[0], c[1])})
    lo = hi = 0
    out = []
    while lo < total and len(out) < 4 * (total // max(1, lower) + 2):
        k = bisect_right(sure, lo + lower) - 1
        nlo = sure[k] if k >= 0 and sure[k] > lo else sure[min(len(sure) - 1, bisect_left(sure, lo + 1))]
        nhi = max(nlo, _open_step(cells, starts, min(total, hi + upper)))
        out.append((nlo, min(total, hi + upper)))
        lo, hi = nlo, nhi
        if total - lo <= 0:
            break
    return out

"""Periods merged per player, operators united, sampling and splits that keep people apart."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merge_periods(frames: list[DataFrame], player: str = "player") -> DataFrame:
    """Players known in every period, the columns of period i as p{i}_<name>."""
    named = [f.select(player, *(F.col(c).alias(f"p{i}_{c}") for c in f.columns if c != player)) for i, f in enumerate(frames)]
    return reduce(lambda a, b: a.join(b, player), named)


def unite_operators(frames: dict[str, DataFrame], letters: str = "abcdefghijklmnopqrstuvwxyz") -> DataFrame:
    """All operators' rows, columns that one lacks as null, and a one-hot column per letter."""
    rows = [f.withColumn("operator_name", F.lit(name)) for name, f in frames.items()]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return out.withColumns({f"ohe_{x}": (F.col("operator_name") == x).cast("int") for x in letters})


def undersample(df: DataFrame, target: str, ratio: int, seed: int = 42, key: str = "player") -> DataFrame:
    """All positives and exactly min(ratio * positives, negatives) negatives, the least by a seeded hash.

    The hash of the last one that stays is found from counts per stretch of hashes, so no
    task sorts or holds the sample; ``key`` names a row.
    """
    counts = df.agg(F.count(F.when(F.col(target) == 1, 1)).alias("p"), F.count(F.when(F.col(target) == 0, 1)).alias("n")).first()
    keep = min(ratio * counts["p"], counts["n"])
    positives, negatives = df.filter(F.col(target) == 1), df.filter(F.col(target) == 0)
    if keep == counts["n"]:
        return positives.unionByName(negatives)
    order = F.struct(F.xxhash64(F.lit(seed), F.col(key)).alias("h"), F.col(key).alias("k"))
    last = _kth_least(negatives.select(order.alias("o")), keep)
    return positives.unionByName(negatives.filter(order <= last) if last is not None else negatives.limit(0))


def _kth_least(rows: DataFrame, k: int, cells: int = 4096, few: int = 8192):
    """The ``k``-th least ``o`` (hash, key) of ``rows`` as a column, by counts in ever finer stretches of hashes."""
    if not k:
        return None
    low, high = -(2**63), 2**63 - 1
    while True:
        width = max(1, -(-(high - low + 1) // cells))
        inside = rows.filter((F.col("o.h") >= low) & (F.col("o.h") <= high))
        cell = F.floor((F.col("o.h").cast("decimal(38,0)") - F.lit(str(low)).cast("decimal(38,0)")) / F.lit(str(width)).cast("decimal(38,0)")).cast("long")
        for c, n in sorted((r["c"], r["n"]) for r in inside.groupBy(cell.alias("c")).agg(F.count("*").alias("n")).collect()):  # at most ``cells``
            if k <= n:
                break
            k -= n
        low, high = low + c * width, min(high, low + (c + 1) * width - 1)
        if n <= few or low == high:
            held = rows.filter((F.col("o.h") >= low) & (F.col("o.h") <= high)).orderBy("o").limit(k).collect()  # at most ``few``, but for equal hashes
            o = held[-1]["o"]
            return F.struct(F.lit(o["h"]).alias("h"), F.lit(o["k"]).alias("k"))


def person_key(operator: str = "operator", person: str = "person"):
    """One key of operator and person that no other pair shares."""
    return F.to_json(F.array(F.col(operator).cast("string"), F.col(person).cast("string")))


def person_holdout(df: DataFrame, key: str, percent: int = 20, seed: int = 42) -> DataFrame:
    """Adds held_out: all rows of a person on one side, by a hash of the person."""
    return df.withColumn("held_out", F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(100)) < percent)


def person_folds(df: DataFrame, key: str, folds: int = 5, seed: int = 42) -> DataFrame:
    return df.withColumn("fold", F.pmod(F.xxhash64(F.lit(seed), F.lit(1), F.col(key)), F.lit(folds)).cast("int"))


def operator_folds(names: list[str], n: int, seed: int = 42) -> list[list[str]]:
    """Operators shuffled by a seed and dealt into ``n`` folds."""
    import random

    order = sorted(names)
    random.Random(seed).shuffle(order)
    return [order[k::n] for k in range(n)]


def check_identities(left: DataFrame, right: DataFrame, player: str = "player", person: str = "person") -> DataFrame:
    """Players whose person differs between two periods."""
    both = left.select(player, F.col(person).alias("a")).join(right.select(player, F.col(person).alias("b")), player)
    return both.filter(~F.col("a").eqNullSafe(F.col("b")))


def next_event(closed: DataFrame, placed: DataFrame, by: list[str], us: str = "us") -> DataFrame:
    """As-of join: for every row of ``closed`` the first ``placed`` time strictly later, in one sort.

    A union and one window instead of a range join. Read backwards in time the frame, all
    that is strictly later, grows by a row at a time, so a key costs what its rows cost.
    """
    both = closed.select(*by, us, F.lit(1).alias("__kind")).unionByName(placed.select(*by, us, F.lit(0).alias("__kind")))
    later = Window.partitionBy(*by).orderBy(-F.col(us)).rangeBetween(Window.unboundedPreceding, -1)
    found = both.withColumn("next_us", F.min(F.when(F.col("__kind") == 0, F.col(us))).over(later))
    return found.filter("__kind = 1").drop("__kind")


def distinct_sketch(df: DataFrame, by: list[str], value: str, lg_k: int = 10) -> DataFrame:
    """Distinct values per group by a theta sketch, which keeps the least hashes: exact for
    fewer than its size, beyond that an estimate. ``sketch`` merges with others of its kind."""
    out = df.groupBy(*by).agg(F.theta_sketch_agg(value, lg_k).alias("sketch"))
    return out.select(*by, F.theta_sketch_estimate("sketch").alias("distinct_estimate"), "sketch")


def distinct_counts(df: DataFrame, by: list[str], value: str, lg_k: int = 10) -> DataFrame:
    """Distinct values per group, exact: by the sketch where it holds them all, and counted in
    the groups whose estimate reaches the sketch's size."""
    # the sketch leaves empty strings out
    marked = df.withColumn(value, F.concat(F.lit("="), F.col(value))) if dict(df.dtypes)[value] == "string" else df
    sketches = distinct_sketch(marked, by, value, lg_k)
    held = F.col("distinct_estimate") < 2**lg_k
    large = sketches.filter(~held).select(*(F.col(c).alias(f"__{c}") for c in by))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by), F.lit(True))
    rest = df.join(F.broadcast(large), same, "left_semi")  # few groups: each has about 2**lg_k rows at least
    counted = rest.groupBy(*by).agg(F.count_distinct(value).alias("distinct_count"))
    counted = counted if by else counted.join(large, F.lit(True), "left_semi")  # a total of no rows is a row
    return sketches.filter(held).select(*by, F.col("distinct_estimate").cast("long").alias("distinct_count")).unionByName(counted)


def merged_sketches(sketches: DataFrame, by: list[str], lg_k: int = 12) -> DataFrame:
    """Distinct values over the union of the groups' sketches."""
    return sketches.groupBy(*by).agg(F.theta_sketch_estimate(F.theta_union_agg("sketch", lg_k)).alias("distinct_estimate"))


def extract_targets(df: DataFrame, player: str = "player", start: str = "y_") -> DataFrame:
    """The player and the columns of targets."""
    return df.select(player, *(c for c in df.columns if c.startswith(start)))


def with_target(features: DataFrame, targets: DataFrame, name: str, player: str = "player") -> DataFrame:
    """Features with one target; players without it stay, unknown. A target that the features
    carry gives way to that of ``targets``, so there is one column of the name."""
    one = targets.groupBy(player).agg(F.max(name).alias(name))
    return features.drop(name).join(one, player, "left")


def with_operator_stats(rows: DataFrame, stats: DataFrame, prefix: str = "stats_") -> DataFrame:
    """The single row of an operator's statistics as constants on every row."""
    named = stats.select(*(F.col(c).alias(f"{prefix}{c}") for c in stats.columns))
    return rows.crossJoin(F.broadcast(named.limit(1)))  # one row


def merged_scenario(periods: list[DataFrame], targets: DataFrame | None = None, target: str | None = None, lookup: DataFrame | None = None, stats: list[DataFrame] | None = None) -> DataFrame:
    """One operator's rows for modelling: periods side by side, the flag of activity, the
    target, and the statistics of each period."""
    from wagerlens.operators.versions import active_flag

    out = merge_periods(periods)
    if lookup is not None:
        out = active_flag(out, lookup)
    if targets is not None:
        out = with_target(out, targets, target)
    for i, s in enumerate(stats or []):
        out = with_operator_stats(out, s, f"p{i}_stats_")
    return out


def without_reserved(df: DataFrame, reserved: DataFrame, key: str = "key") -> DataFrame:
    """Rows of people that aren't reserved for the test."""
    return df.join(reserved.select(key).distinct(), key, "left_anti")


def only_variables(df: DataFrame, names: list[str], keep: tuple[str, ...] = ("player",)) -> DataFrame:
    """The columns whose name without its period prefix is listed."""
    import re

    return df.select(*(c for c in df.columns if c in keep or re.sub(r"^p\d+_", "", c) in names))


def stratified_folds(df: DataFrame, key: str, target: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """Adds fold: people with and without a positive row are dealt out apart, so that every
    fold has its share of both; all rows of a person are in one fold.

    People of a class are dealt by their place in the order of a seeded hash, within
    buckets of hashes whose sizes are added up first; no window spans a class.
    """
    people = df.groupBy(key).agg(F.max(F.col(target).cast("int")).alias("__y")).withColumn("__h", F.xxhash64(F.lit(seed), F.col(key)))
    people = people.withColumn("__b", F.pmod("__h", F.lit(256)))
    sizes = people.groupBy("__y", "__b").agg(F.count("*").alias("__n"))  # at most 256 a class
    before = Window.partitionBy("__y").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__y", "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    place = F.row_number().over(Window.partitionBy("__y", "__b").orderBy("__h", key)) - 1
    known = people.withColumn("__place", place).alias("p").join(F.broadcast(starts).alias("s"), F.col("p.__y").eqNullSafe(F.col("s.__y")) & (F.col("p.__b") == F.col("s.__b")))
    dealt = known.select(F.col(f"p.{key}").alias(key), F.pmod(F.col("__start") + F.col("__place"), F.lit(folds)).cast("int").alias("fold"))
    return df.join(dealt, key)

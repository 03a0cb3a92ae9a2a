"""Outlier labels of registration and modification times: bulk imports and recurring jobs.

Counts of distinct players per day, hour and minute are compared by the robust score
0.6745 * (x - median) / MAD, with a MAD of 0 taken as 1. All levels come from one
aggregation by minute; the higher ones are roll-ups of distinct players.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DAY, HOUR, MINUTE = 86_400_000_000, 3_600_000_000, 60_000_000


def robust_scores(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """Adds med, mad and score of ``value``, over all rows or within ``by``."""
    keys = by or []
    med = df.groupBy(*keys).agg(F.median(value).alias("med"))
    joined = df.join(med, keys) if keys else df.crossJoin(F.broadcast(med))  # one row; keyed medians join as their size has it
    mads = joined.groupBy(*keys).agg(F.median(F.abs(F.col(value) - F.col("med"))).alias("mad"))
    joined = joined.join(mads, keys) if keys else joined.crossJoin(F.broadcast(mads))
    scale = F.when(F.col("mad") == 0, 1.0).otherwise(F.col("mad"))
    return joined.withColumn("score", F.round(0.6745 * (F.col(value) - F.col("med")) / scale, 6))


def player_cubes(df: DataFrame, us: str = "extracted_us", player: str = "player") -> DataFrame:
    """Distinct players per month of 30 days, day and hour, by one pass over grouping sets."""
    base = df.filter(F.col(us).isNotNull()).select(player, *(F.floor(F.col(us) / w).cast("long").alias(n) for n, w in (("month", 30 * DAY), ("day", DAY), ("hour", HOUR))))
    sets = base.groupingSets([["month"], ["month", "day"], ["month", "day", "hour"]], "month", "day", "hour")
    return sets.agg(F.countDistinct(player).alias("players"))


def bulk_days(df: DataFrame, us: str, least: int = 100, score: float = 6.0, factor: float = 10.0) -> DataFrame:
    """(day, hour) of imports: days over ``score`` with ``least`` rows, in them hours over ``factor`` times the mean hour."""
    days = df.groupBy(F.floor(F.col(us) / DAY).cast("long").alias("day")).agg(F.count("*").alias("n"))
    odd = robust_scores(days, "n").filter((F.col("score") > score) & (F.col("n") >= least)).select("day")
    hours = df.groupBy(F.floor(F.col(us) / DAY).cast("long").alias("day"), F.floor(F.col(us) / HOUR).cast("long").alias("hour")).agg(F.count("*").alias("n"))
    mean = hours.agg(F.avg("n").alias("mean"))
    return hours.join(odd, "day").crossJoin(F.broadcast(mean)).filter(F.col("n") > factor * F.col("mean")).select("day", "hour")  # one row


def label_bins(df: DataFrame, us: str = "extracted_us", player: str = "player", bands=((1, 70.0, None, 10.0), (2, 20.0, 70.0, 5.0)), minute_factor: float = 5.0) -> DataFrame:
    """(label, level, bin): days whose players score within a band, refined to their odd
    hours and those to their odd minutes; a level without odd bins is labelled itself."""
    minutes = df.filter(F.col(us).isNotNull()).select(player, *(F.floor(F.col(us) / w).cast("long").alias(n) for n, w in (("day", DAY), ("hour", HOUR), ("minute", MINUTE)))).distinct()

    def players(level: str, *more: str) -> DataFrame:
        return minutes.groupBy(level, *more).agg(F.countDistinct(player).alias("players"))

    days = robust_scores(players("day"), "players")
    out = None
    for label, low, high, factor in bands:
        odd = days.filter((F.col("score") > low) & (F.lit(True) if high is None else F.col("score") <= high)).select("day")
        hours = players("hour", "day").join(odd, "day")
        hours = hours.withColumn("mean", F.avg("players").over(Window.partitionBy("day")))
        odd_hours = hours.filter(F.col("players") > factor * F.col("mean")).select("day", "hour")
        mins = players("minute", "hour").join(odd_hours, "hour")
        mins = mins.withColumn("mean", F.avg("players").over(Window.partitionBy("hour")))
        odd_minutes = mins.filter(F.col("players") > minute_factor * F.col("mean")).select("day", "hour", "minute")
        whole_hours = odd_hours.join(odd_minutes, "hour", "left_anti")
        whole_days = odd.join(odd_hours, "day", "left_anti")
        bins = (
            odd_minutes.select(F.lit("minute").alias("level"), F.col("minute").alias("bin"))
            .union(whole_hours.select(F.lit("hour"), F.col("hour")))
            .union(whole_days.select(F.lit("day"), F.col("day")))
            .select(F.lit(label).alias("label"), "level", "bin")
        )
        out = bins if out is None else out.union(bins)
    return out


def touched_days(bins: DataFrame) -> DataFrame:
    """Days in which any labelled day, hour or minute lies."""
    per = F.when(F.col("level") == "day", F.col("bin")).when(F.col("level") == "hour", F.floor(F.col("bin") / 24)).otherwise(F.floor(F.col("bin") / 1440))
    return bins.select(per.cast("long").alias("day")).distinct()


def recurring_minutes(df: DataFrame, us: str = "extracted_us", player: str = "player", score: float = 8.0, touched: DataFrame | None = None) -> DataFrame:
    """(month, minute_of_day): minutes whose median of distinct players over days stands out in
    their month; ``touched`` days, those with other labels, are left out."""
    rows = df.filter(F.col(us).isNotNull()).select(player, F.floor(F.col(us) / (30 * DAY)).cast("long").alias("month"), F.floor(F.col(us) / DAY).cast("long").alias("day"), F.floor((F.col(us) % DAY) / MINUTE).cast("long").alias("minute_of_day"))
    if touched is not None:
        rows = rows.join(touched, "day", "left_anti")
    per_day = rows.groupBy("month", "day", "minute_of_day").agg(F.countDistinct(player).alias("players"))
    usual = per_day.groupBy("month", "minute_of_day").agg(F.median("players").alias("usual"))
    return robust_scores(usual, "usual", ["month"]).filter(F.col("score") > score).select("month", "minute_of_day")


def label_times(df: DataFrame, us: str = "extracted_us", player: str = "player", bands=((1, 70.0, None, 10.0), (2, 20.0, 70.0, 5.0)), minute_factor: float = 5.0, score: float = 8.0) -> DataFrame:
    """The whole job: labels 1 and 2 by bins, label 3 on the days that those don't touch, then every row's label."""
    bins = label_bins(df, us, player, bands, minute_factor)
    return labelled(df, bins, recurring_minutes(df, us, player, score, touched_days(bins)), us)


def labelled(df: DataFrame, bins: DataFrame, recurring: DataFrame, us: str = "extracted_us") -> DataFrame:
    """Adds outlier_label: 3 for recurring minutes, over it 1, over it 2 from bins; else 0."""
    out = df.withColumns({n: F.floor(F.col(us) / w).cast("long") for n, w in (("__day", DAY), ("__hour", HOUR), ("__minute", MINUTE), ("__month", 30 * DAY))}).withColumn("__mod", F.floor((F.col(us) % DAY) / MINUTE).cast("long"))
    for level in ("day", "hour", "minute"):
        some = bins.filter(F.col("level") == level).groupBy(F.col("bin").alias(f"__{level}")).agg(F.max("label").alias(f"__l_{level}"))
        out = out.join(some, f"__{level}", "left")
    again = recurring.select(F.col("month").alias("__month"), F.col("minute_of_day").alias("__mod"), F.lit(3).alias("__l3")).distinct()
    out = out.join(again, ["__month", "__mod"], "left")
    label = F.coalesce(F.greatest("__l_day", "__l_hour", "__l_minute"), "__l3", F.lit(0))
    return out.withColumn("outlier_label", label).drop(*(c for c in out.columns if c.startswith("__")))

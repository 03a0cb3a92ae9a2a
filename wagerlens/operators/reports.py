"""Descriptive and model reports: aggregation in Spark, text on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def summary(df: DataFrame, leave: tuple[str, ...] = ("player",)) -> DataFrame:
    """One row per numeric column: rows, nulls, mean, deviation, least, quartiles, largest; one scan."""
    cols = [c for c, t in df.dtypes if c not in leave and t in ("double", "float", "int", "bigint")]
    if not cols:
        return df.sparkSession.createDataFrame([], "name string, n long, nulls long, mean double, std double, q array<double>")
    x = {c: F.col(c).cast("double") for c in cols}
    each = [F.struct(F.lit(c).alias("name"), F.count(v).alias("n"), F.count_if(v.isNull()).alias("nulls"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.percentile_approx(v, [0.0, 0.25, 0.5, 0.75, 1.0]).alias("q")) for c, v in x.items()]
    return df.agg(F.array(*each).alias("rows")).select(F.inline("rows"))


def described(df: DataFrame, by: list[str], column: str, other: str | None = None) -> DataFrame:
    """Per group: rows, mean, deviation and exact quartiles of a column, and its correlation with another."""
    x = F.col(column)
    picks = [F.count("*").alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), *(F.percentile(x, F.lit(q)).alias(n) for n, q in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75)))]
    if other:
        picks.append(F.corr(x, F.col(other).cast("double")).alias(f"corr_{other}"))
    out = df.groupBy(*by).agg(*picks)
    return out.select(*by, "n", *(F.round(c, 6).alias(c) for c in out.columns if c not in (*by, "n")))


def target_balance(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy(target).agg(F.count("*").alias("n"))


def correlations(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """Correlation of each column with the target, strongest first."""
    row = df.agg(F.array(*(F.struct(F.lit(c).alias("name"), F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias("corr")) for c in columns)).alias("r"))
    return row.select(F.inline("r")).orderBy(F.desc(F.abs("corr")), "name")


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width bins between the least and largest value."""
    edge = df.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))
    placed = df.filter(F.col(column).isNotNull()).crossJoin(F.broadcast(edge))  # one row
    at = F.when(F.col("hi") == F.col("lo"), 0).otherwise(F.least(F.lit(bins - 1), F.floor((F.col(column) - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)))
    return placed.groupBy(at.cast("int").alias("bin")).agg(F.count("*").alias("n"), F.min(column).alias("lowest"), F.max(column).alias("highest"))


def trial_table(trials: DataFrame, by: list[str], metric: str = "areaUnderPR_mean") -> DataFrame:
    """Trials per combination with mean, deviation and best metric, best first."""
    return trials.groupBy(*by).agg(F.count("*").alias("trials"), F.avg(metric).alias("mean"), F.stddev_samp(metric).alias("std"), F.max(metric).alias("best")).orderBy(F.desc("best"), *by)


def coverage(trials: DataFrame, expected: dict[str, int], model: str = "model") -> DataFrame:
    """Done and expected trials of each model."""
    wanted = trials.sparkSession.createDataFrame(sorted(expected.items()), f"{model} string, expected long")
    done = trials.groupBy(model).agg(F.count("*").alias("done"))
    return wanted.join(done, model, "left").select(model, F.coalesce("done", F.lit(0)).alias("done"), "expected", F.round(F.coalesce("done", F.lit(0)) / F.col("expected"), 4).alias("share"))


def as_text(df: DataFrame, title: str, limit: int = 50) -> str:
    """A titled plain-text table of a report's first rows."""
    rows = [df.columns, *([("" if v is None else f"{v:.4f}" if isinstance(v, float) else str(v)) for v in r] for r in df.limit(limit).collect())]
    widths = [max(len(r[k]) for r in rows) for k in range(len(df.columns))]
    lines = ["  ".join(v.ljust(w) for v, w in zip(r, widths, strict=True)).rstrip() for r in rows]
    return "\n".join([title, "=" * len(title), lines[0], "-" * len(lines[0]), *lines[1:]])

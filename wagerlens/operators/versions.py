"""Latest-version selection, ordering and status lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_wins(df: DataFrame, keys: list[str], times: list[str], last: list[str]) -> DataFrame:
    """The latest row of each key: by the first time that is known, then by the others, then ``last``.

    Rows in which a key is null or empty are no versions of anything and all stay.
    """
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull() & (F.trim(F.col(k).cast("string")) != "")
    order: list[Column] = [F.coalesce(*times).desc_nulls_last(), *(F.col(t).desc_nulls_last() for t in times[1:]), *(F.col(c).desc_nulls_last() for c in last)]
    ranked = df.filter(known).withColumn("__k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("__k = 1").drop("__k").unionByName(df.filter(~known))


def with_parent_operator(child: DataFrame, parent: DataFrame, fk: str, pk: str, operator: str = "operator") -> DataFrame:
    """The row's own operator, else its parent's (the last one that the parent key has)."""
    parents = parent.filter(F.col(operator).isNotNull()).groupBy(F.col(pk).alias("__pk")).agg(F.max(operator).alias("__operator"))
    joined = child.join(parents, F.col(fk) == F.col("__pk"), "left")
    own = F.col(operator) if operator in child.columns else F.lit(None)
    return joined.withColumn(operator, F.coalesce(own, "__operator")).drop("__pk", "__operator")


def write_monthly(df: DataFrame, ts: str, path: str, ties: list[str] | None = None) -> None:
    """Sorted layout by month: one folder per month, rows in time order; rows without a time under ``none``.

    Rows of a month meet by month and day, so one month isn't one task.
    """
    month = F.coalesce(F.date_format(ts, "yyyy_MM"), F.lit("none"))
    laid = df.withColumn("ym", month).repartition("ym", F.to_date(ts)).sortWithinPartitions("ym", ts, *(ties or []))
    laid.write.mode("overwrite").partitionBy("ym").parquet(path)


def last_status(df: DataFrame, cutoffs: list[int], player: str = "player", status: str = "status", modified: str = "modified_us", ties: tuple[str, ...] = ("pk",)) -> DataFrame:
    """Last known status before each cutoff, of all cutoffs in one pass over the history."""
    spark_cutoffs = F.explode(F.array(*(F.lit(c).cast("long") for c in cutoffs)))
    rows = df.filter(F.col(status).isNotNull()).select(player, status, modified, *ties, spark_cutoffs.alias("cutoff"))
    last = F.max_by(status, F.struct(modified, *ties))
    return rows.filter(F.col(modified) < F.col("cutoff")).groupBy("cutoff", player).agg(last.alias("last_status"))


def active_flag(features: DataFrame, lookup: DataFrame, inactive: tuple[str, ...] = ("SELF_EXCLUDED_TEMP", "SELF_EXCLUDED_INDEF", "SUSPENDED_DEATH", "BLOCKED")) -> DataFrame:
    """Adds ACTIVE_FLAG: whether the last known status is one of play; unknown players aren't active."""
    flagged = lookup.select("player", (~F.col("last_status").isin(*inactive)).alias("active_flag"))
    return features.join(flagged, "player", "left").withColumn("active_flag", F.coalesce("active_flag", F.lit(False)))


def only_active(df: DataFrame, flag: str = "active_flag") -> DataFrame:
    """Rows whose flag isn't false; an unknown flag stays."""
    return df.filter(F.coalesce(F.col(flag), F.lit(True)))


#: Column that each table is laid out by; tables without one are copied as they stand.
SORT_COLUMNS = {"tx": "ts", "bet": "us", "ses": "us", "prof": "modified_us", "lim": "us"}


def audited_monthly(df: DataFrame, ts: str, path: str, ties: list[str] | None = None) -> dict[str, int]:
    """``write_monthly`` and a count: rows written must be rows read, and no month may be out of order."""
    spark = df.sparkSession
    write_monthly(df, ts, path, ties)
    rows_in, back = df.count(), spark.read.parquet(path)
    rows_out = back.count()
    if rows_in != rows_out:
        raise ValueError(f"{rows_in} rows in, {rows_out} out")
    strange = back.filter((F.col("ym") != "none") & (F.col("ym") != F.date_format(ts, "yyyy_MM"))).count()
    if strange:
        raise ValueError(f"{strange} rows stand in a month that isn't theirs")
    return {"rows": rows_out, "months": back.select("ym").distinct().count()}

"""Writers: feature tables, status lookups per cutoff, model datasets with a manifest, column needs."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def swap_in(df: DataFrame, path: str) -> None:
    """Write beside ``path`` and take its place only when the whole table is there.

    ``df`` may read ``path`` itself. Readers see the old table, or for a moment none, never half of one.
    """
    jvm = df.sparkSession._jvm
    new, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    df.write.parquet(new)
    here, there, gone = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, new, old))
    fs = here.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    if fs.exists(here) and not fs.rename(here, gone):
        raise OSError(f"{path} can't be moved away")
    if not fs.rename(there, here):
        if fs.exists(gone):
            fs.rename(gone, here)
        raise OSError(f"{new} can't take the place of {path}")
    if fs.exists(gone):
        fs.delete(gone, True)


def write_trials(trials: list[dict], path: str, spark: SparkSession, metric: str = "areaUnderPR_mean") -> dict:
    """Results of a search, its best trial and a manifest; the best is returned."""
    best = max(trials, key=lambda t: (t[metric] is not None and t[metric] == t[metric], t[metric] or 0.0))
    rows = [(json.dumps(t, sort_keys=True),) for t in trials]
    spark.createDataFrame(rows, "trial string").coalesce(1).write.mode("overwrite").text(f"{path}/results")
    meta = {"id": uuid.uuid4().hex, "trials": len(trials), "metric": metric, "best": best}
    spark.createDataFrame([(json.dumps(meta, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")
    return best


def write_features(df: DataFrame, path: str, kind: str = "parquet", key: str = "player") -> None:
    """One row per player (the first by all columns where a player repeats), as Parquet or CSV."""
    from pyspark.sql import Window

    once = df.withColumn("__k", F.row_number().over(Window.partitionBy(key).orderBy(*df.columns))).filter("__k = 1").drop("__k")
    writer = once.write.mode("overwrite")
    writer.option("header", True).csv(path) if kind == "csv" else writer.parquet(path)


def write_lookup(lookup: DataFrame, path: str, overwrite: bool = False) -> None:
    """Last statuses, one folder per cutoff; without ``overwrite`` cutoffs that exist already stay."""
    spark = lookup.sparkSession
    if not overwrite:
        try:
            done = [r[0] for r in spark.read.parquet(path).select("cutoff").distinct().collect()]
        except Exception as e:  # the first write
            if "PATH_NOT_FOUND" not in str(e):
                raise
            done = []
        lookup = lookup.filter(~F.col("cutoff").isin(done)) if done else lookup
        lookup.write.mode("append").partitionBy("cutoff").parquet(path)
        return
    lookup.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("cutoff").parquet(path)


def write_dataset(train: DataFrame, test: DataFrame, path: str, target: str, identity: str | None = None) -> dict:
    """Train and test rows and a manifest that says what they hold; returned and written."""
    spark = train.sparkSession
    out = {"id": uuid.uuid4().hex, "target": target, "identity": identity, "columns": [c for c in train.columns if c != target]}
    for name, df in (("train", train), ("test", test)):
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        counts = spark.read.parquet(f"{path}/{name}").agg(F.count("*").alias("n"), F.count(F.when(F.col(target) == 1, 1)).alias("p")).first()
        out[name] = {"rows": counts["n"], "positives": counts["p"]}
    spark.createDataFrame([(json.dumps(out),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
    return out


def read_dataset(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, dict]:
    """(train, test, manifest); refuses rows that don't match their manifest, or people on both sides."""
    manifest = json.loads(spark.read.text(f"{path}/manifest").first()[0])
    train, test = spark.read.parquet(f"{path}/train"), spark.read.parquet(f"{path}/test")
    if (train.count(), test.count()) != (manifest["train"]["rows"], manifest["test"]["rows"]):
        raise ValueError(f"{path}: rows don't match the manifest")
    if manifest["identity"] and not train.select(manifest["identity"]).join(test.select(manifest["identity"]), manifest["identity"], "left_semi").isEmpty():
        raise ValueError(f"{path}: people stand on both sides")
    return train, test, manifest


def column_needs() -> list[tuple[str, str]]:
    """(table, plan) pairs: which domain tables each feature reads."""
    from wagerlens.plans.features import FEATURES, needed

    return sorted((t, k) for k in FEATURES for t in needed(k)[1])

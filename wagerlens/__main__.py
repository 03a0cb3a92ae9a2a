"""Command line, over --data:

python -m wagerlens list | run QUERY | scenario NAME | lookup | report | stats NAME |
clean TABLE --schema FILE [--tenant X] | sort TABLE --by COLUMN | label TABLE --by COLUMN
"""

from __future__ import annotations

import argparse
import json
import time


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="wagerlens")
    parser.add_argument("command", choices=("list", "run", "scenario", "lookup", "report", "stats", "clean", "sort", "label"))
    parser.add_argument("name", nargs="?", help="query, or scenario")
    parser.add_argument("--data", help="folder of the input tables")
    parser.add_argument("--out", help="folder to write to; without it rows are shown")
    parser.add_argument("--first-day", type=int, help="first day of the window, in days since 1970")
    parser.add_argument("--last-day", type=int, help="day after the window")
    parser.add_argument("--csv", action="store_true", help="write CSV instead of Parquet")
    parser.add_argument("--schema", help="JSON file: column to type specification")
    parser.add_argument("--tenant", default="", help="whose rules hold when cleaning")
    parser.add_argument("--by", help="time column to sort by (a timestamp) or to label (microseconds)")
    parser.add_argument("--log", help="file to which a line on the run is added")
    a = parser.parse_args(args)
    began = time.monotonic()
    try:
        return _run(a, parser)
    finally:
        if a.log:
            import resource

            line = {"command": a.command, "name": a.name, "seconds": round(time.monotonic() - began, 3), "driver_mb": resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1000}
            with open(a.log, "a") as f:
                f.write(json.dumps(line) + "\n")


def _table(a, spark, parser) -> int:
    """Jobs over one table of --data, written to --out."""
    from wagerlens.operators import cleaning, outliers, versions
    from wagerlens.sources import sinks

    if not (a.name and a.out):
        parser.error("a table and --out are needed")
    df = spark.read.parquet(f"{a.data}/{a.name}.parquet")
    if a.command == "clean":
        with open(a.schema) as f:
            cleaning.clean_job(df, json.load(f), a.out, a.tenant, a.name).show(1000, truncate=False)
    elif a.command == "sort":
        print(versions.audited_monthly(df, a.by, a.out))
    else:
        sinks.swap_in(outliers.label_times(df, a.by), a.out)
    return 0


def _run(a, parser) -> int:

    from wagerlens import catalog
    from wagerlens.plans.engine import DEFAULT, SCENARIOS, FeatureContext, stats_row
    from wagerlens.plans.features import DAY_US, Window

    if a.command == "list":
        print("\n".join(["queries: " + " ".join(sorted(catalog.queries())), "scenarios: " + " ".join(SCENARIOS)]))
        return 0
    if not a.data:
        parser.error("--data is needed")
    from pyspark.sql import SparkSession

    from wagerlens.operators import reports, versions
    from wagerlens.sources import sinks

    spark = SparkSession.builder.appName("wagerlens").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command in ("clean", "sort", "label"):
        return _table(a, spark, parser)
    window = Window(a.first_day or DEFAULT.first_day, a.last_day or DEFAULT.last_day)
    ctx = FeatureContext.of(spark, a.data, window)
    if a.command == "run":
        df = catalog.queries()[a.name](spark, a.data)
    elif a.command == "lookup":
        df = versions.last_status(ctx.tables["prof"], [window.last_day * DAY_US])
        if a.out:
            sinks.write_lookup(df, a.out)
            return 0
    else:
        df = ctx.scenario(a.name or "core")
        if a.command == "stats":
            df = stats_row(df)
        if a.command == "report":
            print(reports.as_text(reports.summary(df).drop("q"), f"Scenario {a.name or 'core'}"))
            return 0
    if a.out and a.command == "scenario":
        sinks.write_features(df, a.out, "csv" if a.csv else "parquet")
    elif a.out:
        writer = df.write.mode("overwrite")
        writer.option("header", True).csv(a.out) if a.csv else writer.parquet(a.out)
    else:
        df.show(20, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

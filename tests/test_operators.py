"""Cleaning, files, versions, labels, merging and streaming on literal rows."""

import datetime
import time

import pytest
from pyspark.sql import functions as F

from wagerlens.functions import coerce
from wagerlens.operators import merging, modelling, outliers, versions
from wagerlens.sources import files
from wagerlens.sources.domain import with_time


def test_coercions(spark):
    df = spark.createDataFrame(
        [(" 2024-03-01", "2024-03-31T00:30:00+01:00", "TRUE", "12.0", "1,5", "007.0"), ("1/3/2024", "2024-03-01 10:00:00", "0", "x", "n/a", " a "), (None, "bad", "maybe", "", "1.2.3", "NULL")],
        "d string, t string, b string, i string, n string, id string",
    )
    types = {"d": "date", "t": "datetime", "b": "bool", "i": "int", "n": "number", "id": "id"}
    day = datetime.date(2024, 3, 1)
    assert [tuple(r) for r in coerce.clean(df, types).collect()] == [
        (day, "2024-03-30T23:30:00Z", True, 12, 1.5, "007"),
        (day, "2024-03-01T10:00:00Z", False, None, None, "a"),
        (None, None, None, None, None, None),
    ]
    assert coerce.violations(df, {"i": "int"}, ["d"]).first().asDict() == {"i_unreadable": 1, "d_missing": 1}


def test_json_forms(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('"[{""a"": 2}, {""a"": 3}]"',), ("{'a': None}",), ("broken",), (None,)], "j string")
    got = [[x.a for x in r[0]] if r[0] is not None else None for r in df.select(coerce.json_list(F.col("j"), {"a": "int"})).collect()]
    assert got == [[1], [2, 3], [None], None, None]


def test_file_names_and_formats(spark, tmp_path):
    tables = ["WOK_Bet", "WOK_Bet_Parts"]
    assert files.find_tables(["x/B_WOK_Bet_10.csv", "x/wok_bet_2.csv", "x/WOK_Bet_Parts_out.csv", "archive/WOK_Bet.csv", "x/other.csv"], tables) == {"WOK_Bet": ["x/B_WOK_Bet_10.csv", "x/wok_bet_2.csv"], "WOK_Bet_Parts": ["x/WOK_Bet_Parts_out.csv"]}
    (tmp_path / "a_1.csv").write_text('ID;Amount\n1;"2,5"\n2;NULL\n')
    (tmp_path / "a_2.csv").write_text("|id|,|amount|\n|3|,|4.5|\n")
    (tmp_path / "a_3.csv").write_text("")
    df = files.read_table(spark, [str(p) for p in tmp_path.iterdir()], ["id", "amount", "absent"])
    assert sorted((r.id, r.amount, r.absent) for r in df.collect()) == [("1", "2,5", None), ("2", None, None), ("3", "4.5", None)]
    assert files.requirements({"f0": {"tx": ["b", "a"]}, "f1": {"tx": ["a"]}}) == [("tx", "a"), ("tx", "b")]


def test_latest_version_falls_through_times(spark):
    rows = [(1, "a", 5, None, 1), (1, "a", None, 9, 2), (1, "a", 9, 1, 3), (2, "b", None, None, 4), (2, "b", None, None, 5), (3, None, 1, 1, 6), (3, "", 1, 1, 7)]
    df = spark.createDataFrame(rows, "p long, item string, t1 long, t2 long, seq long")
    assert sorted(r.seq for r in versions.latest_wins(df, ["p", "item"], ["t1", "t2"], ["seq"]).collect()) == [2, 5, 6, 7]


def test_monthly_layout_keeps_all_rows(spark, tmp_path):
    df = spark.sql("select id, case when id % 10 <> 0 then timestamp'2024-01-01' + make_interval(0, 0, 0, cast(id as int)) end as ts from range(100)")
    versions.write_monthly(df, "ts", str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 100 and back.filter("ym = 'none'").count() == 10
    assert back.filter("ym = '2024_02' and month(ts) <> 2").count() == 0


def test_last_status_before_each_cutoff(spark):
    rows = [(1, "A", 10, 1), (1, "B", 20, 2), (1, None, 25, 3), (2, "A", 30, 4)]
    df = spark.createDataFrame(rows, "player long, status string, modified_us long, pk long")
    got = sorted(tuple(r) for r in versions.last_status(df, [20, 40]).collect())
    assert got == [(20, 1, "A"), (40, 1, "B"), (40, 2, "A")]


def test_labels_take_their_precedence(spark):
    day = outliers.DAY
    rows = [(p, 60 * day + 5 * outliers.HOUR + 30 * outliers.MINUTE) for p in range(500)]
    rows += [(p, d * day + p * outliers.HOUR % day) for d in range(61, 80) for p in range(d % 3 + 2)]
    df = spark.createDataFrame(rows, "player long, us long")
    bins = outliers.label_bins(df, "us")
    assert [tuple(r) for r in bins.collect()] == [(1, "day", 60)] or bins.filter("label = 1").count() == 1
    got = outliers.labelled(df, bins, outliers.recurring_minutes(df, "us"), "us").groupBy("outlier_label").count().collect()
    assert dict(map(tuple, got)).get(1) == 500


def test_merging_sampling_and_splits(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "player long, x double")
    b = spark.createDataFrame([(2, 5.0), (3, 6.0)], "player long, x double")
    assert [tuple(r) for r in merging.merge_periods([a, b]).collect()] == [(2, 2.0, 5.0)]
    both = merging.unite_operators({"a": a, "q": b.withColumnRenamed("x", "y")})
    assert both.columns[-26:] == [f"ohe_{c}" for c in "abcdefghijklmnopqrstuvwxyz"]
    assert both.agg(F.sum("ohe_a"), F.sum("ohe_q"), F.count("y")).first()[:] == (2, 2, 2)
    y = spark.range(100).select(F.col("id").alias("player"), (F.col("id") < 10).cast("int").alias("y"))
    assert merging.undersample(y, "y", 3).groupBy("y").count().orderBy("y").collect()[0][1] == 30
    split = merging.person_holdout(spark.range(1000).select(F.col("id"), (F.col("id") % 200).cast("string").alias("key")), "key")
    assert split.groupBy("key").agg(F.countDistinct("held_out").alias("n")).filter("n > 1").count() == 0
    assert sorted(sum(merging.operator_folds(list("abcde"), 2), [])) == list("abcde")
    assert merging.operator_folds(list("abcde"), 2) == merging.operator_folds(list("edcba"), 2)
    sketch = merging.distinct_sketch(spark.range(20_000).select((F.col("id") % 2).alias("g"), (F.col("id") % 8000).alias("v")), ["g"], "v", 9)
    assert all(abs(r.distinct_estimate - 4000) < 800 for r in sketch.collect())
    assert abs(merging.merged_sketches(sketch, []).first()[0] - 8000) < 1600  # the groups hold different values
    assert merging.distinct_sketch(spark.range(300).selectExpr("id % 100 as v"), [], "v").first().distinct_estimate == 100


def test_distinct_counts_are_exact_beyond_the_sketch(spark):
    rows = spark.range(9000).selectExpr("if(id < 6000, 1, if(id < 8900, 2, null)) as g", "if(id % 3 = 0, null, id % 4001) as v", "if(id % 2 = 0, '', cast(id % 700 as string)) as s")
    for value in ("v", "s"):
        want = {r[0]: r[1] for r in rows.groupBy("g").agg(F.count_distinct(value)).collect()}
        assert {r[0]: r[1] for r in merging.distinct_counts(rows, ["g"], value, 9).collect()} == want
    assert [r[0] for r in merging.distinct_counts(rows, [], "v", 9).collect()] == [rows.agg(F.count_distinct("v")).first()[0]]
    assert [r[0] for r in merging.distinct_counts(rows.limit(9), [], "v", 9).collect()] == [6]
    assert max(want.values()) < 512 < merging.distinct_counts(rows, [], "v", 9).first()[0]


def test_undersampling_is_exact_and_holds_no_sample(spark):
    y = spark.range(30_000).select(F.col("id").alias("player"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    out = merging.undersample(y, "y", 4)
    assert dict(map(tuple, out.groupBy("y").count().collect())) == {1: 3000, 0: 12_000}
    assert "TakeOrdered" not in out._jdf.queryExecution().toString()
    least = [r[0] for r in y.filter("y = 0").orderBy(F.xxhash64(F.lit(42), "player"), "player").limit(12_000).collect()]
    assert {r[0] for r in out.filter("y = 0").collect()} == set(least)
    assert merging.undersample(y.filter("y = 0"), "y", 4).count() == 0 and merging.undersample(y.limit(0), "y", 2).count() == 0
    assert merging.undersample(y, "y", 100).count() == 30_000


def test_next_event_costs_what_a_key_holds(spark):
    n = 60_000
    rows = spark.range(n).selectExpr("1 as k", "id * 10 as us")
    began = time.perf_counter()
    got = merging.next_event(rows, rows, ["k"]).agg(F.count("*"), F.count("next_us"), F.max(F.col("next_us") - F.col("us"))).first()
    assert tuple(got) == (n, n - 1, 10) and time.perf_counter() - began < 20


def test_folds_hold_both_classes_and_people_stay_whole(spark):
    rows = spark.range(1000).selectExpr("cast(id % 230 as string) as key", "cast(id % 230 < 23 as int) as y")
    out = merging.stratified_folds(rows, "key", "y", 5)
    assert out.count() == 1000 and out.groupBy("key").agg(F.countDistinct("fold").alias("n")).filter("n > 1").count() == 0
    people = out.select("key", "y", "fold").distinct().groupBy("y", "fold").count().collect()
    assert {r["count"] for r in people if r.y == 1} == {4, 5} and len([r for r in people if r.y == 0]) == 5


def test_merged_rows_for_modelling(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "player long, x double")
    y = spark.createDataFrame([(1, 1), (1, 0)], "player long, y_t int")
    stats = spark.createDataFrame([(5.0,)], "m double")
    out = merging.merged_scenario([a, a], y, "y_t", None, [stats, stats])
    assert out.columns == ["player", "p0_x", "p1_x", "y_t", "p0_stats_m", "p1_stats_m"] and {r.player: r.y_t for r in out.collect()} == {1: 1, 2: None}
    assert merging.only_variables(out, ["x"]).columns == ["player", "p0_x", "p1_x"]
    assert merging.extract_targets(out).columns == ["player", "y_t"]
    keyed = out.withColumn("key", F.col("player").cast("string"))
    assert [r.player for r in merging.without_reserved(keyed, keyed.filter("player = 1")).collect()] == [2]
    assert versions.only_active(out.withColumn("active_flag", F.expr("case player when 1 then false end"))).count() == 1


def test_cleaning_job(spark, tmp_path):
    from wagerlens.operators import cleaning
    from wagerlens.sources import files

    assert cleaning.parse_spec("meta:dateTimeUTC|null") == cleaning.Spec(("dateTimeUTC",), True, True)
    raw = spark.createDataFrame([("1.0", "x", "12/31/2024 01:02:03"), ("b", None, "soon"), ("", "N/A", None)], "ID string, name string, Player_Profile_DOB string")
    out = cleaning.clean_table(raw, {"id": "Int", "name": "UID|null"})
    assert [tuple(r)[:2] for r in out.collect()] == [("1", "x"), ("b", None), (None, None)]
    got = {r["name"]: tuple(r)[1:] for r in cleaning.violations(raw, {"id": "Int", "name": "UID|null", "gone": "Int"}).collect()}
    assert got == {"id": (False, 1, 1, "warning"), "name": (False, 0, 0, "none"), "gone": (True, 0, 0, "error")}
    with pytest.raises(ValueError, match="gone"):
        cleaning.clean_table(raw, {"gone": "Int"})
    assert [r[2] for r in cleaning.tenant_filtered(raw, "w", "Player_Profile").collect()] == ["2024-12-31 01:02:03", None, None]
    assert cleaning.tenant_filtered(raw, "w", "bets").collect() == raw.collect() and cleaning.tenant_report(raw, "z", "x").count() == 0
    for _ in range(2):  # the second run takes the first one's place
        report = cleaning.clean_job(raw, {"id": "Int"}, f"{tmp_path}/clean_1")
    assert report.count() == 1 and spark.read.parquet(f"{tmp_path}/clean_1").count() == 3
    cleaning.clean_job(raw.limit(1), {"id": "Int"}, f"{tmp_path}/clean_12")
    assert files.newest(spark, str(tmp_path), r"clean_\d+").endswith("clean_12") and files.newest(spark, f"{tmp_path}/none", ".*") is None
    assert files.missing_tables({"a": ["x"], "b": []}, ["a", "b", "c"]) == ["b", "c"]
    assert [r[0] for r in files.decimal_points(spark.createDataFrame([("1,5",), ("a,b",)], "v string"), ["v"]).collect()] == ["1.5", "a,b"]
    assert [tuple(r) for r in cleaning.passed_on(spark.createDataFrame([("7.0", " none ")], "pk_id string, v string")).collect()] == [("7", None)]


def test_layout_is_audited(spark, tmp_path):
    df = spark.sql("select * from values (timestamp'2024-01-05', 1), (timestamp'2024-02-01', 2), (null, 3) as t(ts, id)")
    assert versions.audited_monthly(df, "ts", f"{tmp_path}/m") == {"rows": 3, "months": 3}


def test_civil_time_over_both_clock_changes(spark):
    df = spark.sql("select * from values (timestamp_ntz'2024-03-31 00:59:59'), (timestamp_ntz'2024-03-31 01:00:00'), (timestamp_ntz'2024-10-27 00:30:00'), (timestamp_ntz'2024-10-27 01:30:00'), (timestamp_ntz'2024-01-01 23:30:00') as t(ts)")
    got = [(r.hour, r.dow) for r in with_time(df, "ts").collect()]
    assert got == [(1, 6), (3, 6), (2, 6), (2, 6), (0, 1)]


def test_grid_and_thresholds(spark):
    assert modelling.expand_grid([{"a": [1, 2], "m": "x"}, {"m": "y"}]) == [{"a": 1, "m": "x"}, {"a": 2, "m": "x"}, {"m": "y"}]
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.7, 1), (0.1, 0)], "score double, y int")
    got = {r.threshold: r for r in modelling.threshold_table(df, "score", "y").collect()}
    assert (got[0.7].tp, got[0.7].fp, got[0.7].fn, got[0.7].tn) == (2, 1, 0, 1)
    assert got[0.9].ppv == 1.0 and got[0.1].npv is None


def test_registry_and_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    out = entry.entry(spark)
    assert out.columns[0] == "player"


def test_sinks_and_reports(spark, tmp_path, capsys):
    from wagerlens.__main__ import main
    from wagerlens.operators import reports
    from wagerlens.sources import sinks

    df = spark.createDataFrame([(1, 1.0, 0), (1, 2.0, 0), (2, None, 1), (3, 9.0, 1)], "player long, x double, y int")
    sinks.write_features(df, f"{tmp_path}/f")
    assert spark.read.parquet(f"{tmp_path}/f").count() == 3
    made = sinks.write_dataset(df.filter("player < 3"), df.filter("player = 3"), f"{tmp_path}/d", "y", "player")
    assert made["train"] == {"rows": 3, "positives": 1}
    assert sinks.read_dataset(spark, f"{tmp_path}/d")[2]["id"] == made["id"]
    look = spark.createDataFrame([(10, 1, "A"), (20, 1, "B")], "cutoff long, player long, last_status string")
    sinks.write_lookup(look.filter("cutoff = 10"), f"{tmp_path}/l")
    sinks.write_lookup(look, f"{tmp_path}/l")
    assert spark.read.parquet(f"{tmp_path}/l").count() == 2
    assert ("tx", "f0") in sinks.column_needs()
    got = {r["name"]: r for r in reports.summary(df).collect()}
    assert (got["x"].n, got["x"].nulls, got["x"].mean) == (3, 1, 4.0)
    assert [tuple(r)[:2] for r in reports.histogram(df, "x", 2).orderBy("bin").collect()] == [(0, 2), (1, 1)]
    trials = spark.createDataFrame([("a", 0.5), ("a", 0.7), ("b", 0.6)], "model string, areaUnderPR_mean double")
    assert reports.trial_table(trials, ["model"]).first()["best"] == 0.7
    assert [tuple(r) for r in reports.coverage(trials, {"a": 4, "c": 2}).orderBy("model").collect()] == [("a", 2, 4, 0.5), ("c", 0, 2, 0.0)]
    assert "model" in reports.as_text(trials, "Trials")
    assert main(["list"]) == 0 and "scenarios: " in capsys.readouterr().out


def test_command_line_jobs(spark, tmp_path, capsys):
    import json

    from wagerlens.__main__ import main

    spark.sql("select * from values ('1.0', timestamp'2024-01-05', 5L, 1L), ('x', timestamp'2024-02-05', 6L, 2L) as t(id, ts, us, player)").write.parquet(f"{tmp_path}/t.parquet")
    (tmp_path / "schema.json").write_text(json.dumps({"id": "Int"}))
    at = ["--data", str(tmp_path), "--log", f"{tmp_path}/log"]
    assert main(["clean", "t", *at, "--schema", f"{tmp_path}/schema.json", "--out", f"{tmp_path}/clean"]) == 0
    assert main(["sort", "t", *at, "--by", "ts", "--out", f"{tmp_path}/sorted"]) == 0
    assert main(["label", "t", *at, "--by", "us", "--out", f"{tmp_path}/labelled"]) == 0
    assert {r.id for r in spark.read.parquet(f"{tmp_path}/clean").collect()} == {"1", "x"} and "'months': 2" in capsys.readouterr().out
    assert "outlier_label" in spark.read.parquet(f"{tmp_path}/labelled").columns
    assert [json.loads(x)["command"] for x in open(f"{tmp_path}/log")] == ["clean", "sort", "label"]

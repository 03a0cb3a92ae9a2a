"""Runs feature plans and scenarios over the domain tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections import Counter
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagerlens.plans.features import DAY_US, FEATURES, Window, compose, fuse, needed
from wagerlens.oracles import independent
from wagerlens.sources.domain import ORACLE_CTES, domain_tables, oracle_order

#: Days since the epoch: 2024-01-08 to 2024-01-22, target window up to 2024-03-01.
DEFAULT = Window(19730, 19744)
#: Balance below which a player counts as run dry.
LEAST_BALANCE = 2

#: The home country, as the club table names it.
HOME = 3

#: Columns whose absence means "unknown" and stays null; all other numbers become 0.
UNKNOWN = ("f25", "f26", "f27", "f28", "f44", "f45", "f48", "f51")

_CORE = ["f0", "f1", "f2", "f3", "f4", "f6", "f7", "f8", "f9", "f10"]
_WIDE = [k for k in FEATURES if k[0] == "f" and k[1:].isdigit()]
_BASIC = [*(k for k in FEATURES if k.startswith("var")), "var10j"]
_MORE = ["f11", "f12", "f14", "f15"]
_AMOUNTS = ["f0", "f1", "f3", "f2", "f4", "f8", *_MORE]
_ACCOUNTS = ["nr_of_bank_accounts", "nr_of_risk_classes"]
#: Named lists of features.
SCENARIOS: dict[str, list[str]] = {
    "legacy_1": ["avg_nr_of_game_transactions"],
    "legacy_2": ["transaction_amount_sum", "transaction_amount_sum_in_games"],
    "legacy_3": ["transaction_amount_sum", "transaction_amount_sum_in_games", "time_eas"],
    "legacy_4": [*_ACCOUNTS, "latest_limits"],
    "legacy_5": ["avg_nr_of_game_transactions", "avg_nr_of_bet_parts_per_bet", "latest_limits"],
    "legacy_6": [*_ACCOUNTS, "avg_nr_of_game_transactions", "avg_nr_of_bet_parts_per_bet", "latest_limits", "complaint_variance"],
    "local_test": [*_ACCOUNTS, "avg_nr_of_game_transactions", "latest_limits", "complaint_variance", "ever_excluded"],
    "tenant_b": [*_ACCOUNTS, "latest_limits", "complaint_variance", "transactions", "ever_excluded"],
    "transactions_and_target": ["transactions", "ever_excluded"],
    "monthly_target": ["monthly_exclusion"],
    "two_months": ["april_may", "june_july"],
    "target_only": ["self_exclusion_y"],
    "flexible": ["flexible_x", "self_exclusion_y"],
    "balance_probe": ["f0", "f26"],
    "balance_probe_target": ["f0", "f26", "self_exclusion_y"],
    "core": _CORE,
    "core_target": [*_AMOUNTS, "self_exclusion_y"],
    "core_suspensions": [*_AMOUNTS, "f25", "self_exclusion_y"],
    "production": [*_WIDE, "self_exclusion_y"],
    "unknown_probe": ["f1", "f8", "f29", "f40", "f41", "f51"],
    "stats_probe": ["f0", "f3", "f25", "f12", "f11"],
    "stake_and_time": ["var1a", "var14", "self_exclusion_y"],
    "basic": _BASIC,
    "basic_target": [*_BASIC, "self_exclusion_y"],
}
#: Features that aren't one row per player, in the form that a scenario takes them.
_WIDENED = {"latest_limits": ("kind", ("BALANCE", "DEPOSIT", "LOGIN"), ("value", "span"))}


def numbers(window: Window) -> dict[str, object]:
    import datetime

    day = datetime.date(1970, 1, 1) + datetime.timedelta(days=window.last_day)
    return {
        **window.names,
        "least": LEAST_BALANCE,
        "ref_day": day.year * 10_000 + day.month * 100 + day.day,
        "home": HOME,
        "y0": window.last_day * DAY_US,
        "y1": (window.last_day + 40) * DAY_US,
    }


#: Frames that meet in one query: each takes a sort, so memory, in every task of the join.
JOINED = 8

#: Shared plans worth staging, each after what it reads.
SHARED = ("txw", "betw", "sesw", "bet_player", "ses_player", "first_bettor", "linked", "link_count", "stake_line", "days", "islands", "day_sums", "f0", "f1", "f3", "f14", "bet_legs", "limit_line", "interaction_hours", "shares", "fallen", "net_stakes")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only on one machine, where the session names none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors reach")
        named = "file://" + tempfile.mkdtemp(prefix="wagerlens-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def kept(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read back."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(frames: list[DataFrame]) -> DataFrame:
    """The frames' columns for every player of any of them: a spine and left joins.

    More than ``JOINED`` frames are computed one at a time in the folder all executors
    share, and meet there in groups, so that the memory of a task doesn't grow with their number.
    """
    if len(frames) > JOINED:
        root = f"{shared_folder(frames[0].sparkSession)}/wagerlens/frames-{uuid.uuid4().hex}"
        frames = [kept(f, f"{root}/0-{i}") for i, f in enumerate(frames)]
        level = 0
        while len(frames) > JOINED:
            level += 1
            groups = [frames[i : i + JOINED] for i in range(0, len(frames), JOINED)]
            frames = [kept(side_by_side(g), f"{root}/{level}-{i}") for i, g in enumerate(groups)]
    spine = reduce(DataFrame.union, [f.select("player") for f in frames]).distinct()
    return reduce(lambda a, b: a.join(b, "player", "left"), frames, spine)


class FeatureContext:
    """Domain tables and a window; every feature is a lazy DataFrame over them."""

    def __init__(self, tables: dict[str, DataFrame], window: Window = DEFAULT):
        self.tables, self.window = tables, window
        self.spark = next(iter(tables.values())).sparkSession

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str, window: Window = DEFAULT) -> FeatureContext:
        return cls(domain_tables(spark, sf_dir), window)

    def one_hot(self, name: str, table: str, column: str, prefix: str) -> DataFrame:
        """One column per value that the table holds: a pivot whose values are read first."""
        values = [r[0] for r in self.tables[table].select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column).collect()]  # classes
        seen = self.tables[table].groupBy("player").pivot(column, values).agg(F.lit(1))
        return seen.select("player", *(F.coalesce(F.col(f"`{v}`"), F.lit(0)).cast("long").alias(f"{prefix}{v}") for v in values))

    def per_player(self, name: str, extra: dict[str, str] | None = None) -> DataFrame:
        """The feature as one row per player."""
        if name == "var10j":
            return self.one_hot(name, "risk", "class", "var10j_rg_")
        df = self.feature(name, extra)
        if name not in _WIDENED:
            return df
        by, values, columns = _WIDENED[name]
        return df.groupBy("player").agg(*(F.max(F.when(F.col(by) == v, F.col(c))).alias(f"{name}_{v.lower()}_{c}") for v in values for c in columns))

    def feature(self, name: str, extra: dict[str, str] | None = None) -> DataFrame:
        given = frozenset(self.tables)
        plans, body, base = compose(name, numbers(self.window), given=given, extra=extra)
        bound = [f"{b} AS (SELECT * FROM {{{b}}})" for b in base]
        query = "WITH " + ",\n".join([*bound, *([plans] if plans else [])]) + "\n" + body
        return self.spark.sql(query, **{b: self.tables[b] for b in base})

    def staged(self, keys: list[str]) -> FeatureContext:
        """A context in which the shared plans that several of ``keys`` read are computed once.

        They are written to the folder all executors share: one scan of the movements
        serves every feature, and a lost executor costs a re-read.
        """
        names, extra = fuse(keys)
        readers = Counter(p for n in names for p in needed(n, extra=extra)[0])
        shared = [p for p in SHARED if readers[p] > 1]
        root = f"{shared_folder(self.spark)}/wagerlens/features-{uuid.uuid4().hex}"
        out = FeatureContext(dict(self.tables), self.window)
        for p in shared:
            out.tables[p] = kept(out.feature(p), f"{root}/{p}")
        return out

    def scenario(self, name: str) -> DataFrame:
        """One row per player that any feature knows; unknown where ``UNKNOWN``, else 0.

        Shared plans are staged, features over the same rows are one aggregation, and
        the frames meet on the player.
        """
        pivots = [k for k in SCENARIOS[name] if k == "var10j"]
        keys = [k for k in SCENARIOS[name] if k not in pivots]
        ctx = self.staged(keys)
        names, extra = fuse(keys)
        out = side_by_side([ctx.per_player(k, extra) for k in [*names, *pivots]])
        zero = [c for c, t in out.dtypes if c != "player" and t != "string" and not c.startswith(tuple(f"{u}_" for u in UNKNOWN))]
        return out.na.fill(0, zero)


def oracle(name: str, window: Window = DEFAULT) -> str:
    """The query for ``name`` in DuckDB's SQL over the registered tables.

    Where there is a text of its own for it, that; else the plan over the other adapters.
    """
    own = independent(name, window)
    if own:
        return "WITH " + ",\n".join([*(f"{b} AS ({ORACLE_CTES[b]})" for b in oracle_order(own[0])), own[1]])
    plans, body, base = compose(name, numbers(window), "duckdb")
    adapters = [f"{b} AS ({ORACLE_CTES[b]})" for b in oracle_order(tuple(base))]
    return "WITH " + ",\n".join([*adapters, *([plans] if plans else [])]) + "\n" + body


def oracle_scenario(name: str, window: Window = DEFAULT) -> str:
    """The scenario in DuckDB's SQL: every player that a feature knows, its columns beside each
    other, unknown where ``UNKNOWN``, else 0."""
    keys = SCENARIOS[name]
    subs = [f"q_{k} AS ({_oracle_per_player(k, window)})" for k in keys]
    spine = " UNION ".join(f"SELECT player FROM q_{k}" for k in keys)
    joins = " ".join(f"LEFT JOIN q_{k} USING (player)" for k in keys)
    # columns that stay as they are: those that may be unknown, and text
    plain = "^(" + "|".join((*(f"{u}_" for u in UNKNOWN), "latest_limits_.*_span$", "y_1c_last_status$")) + ")"
    kept = f"COLUMNS(lambda c: c <> 'player' AND regexp_matches(c, '{plain}')), " if {*UNKNOWN, "latest_limits", "ever_excluded"} & set(keys) else ""
    others = f", coalesce(COLUMNS(lambda c: c <> 'player' AND NOT regexp_matches(c, '{plain}')), 0)" if set(keys) - set(UNKNOWN) else ""
    return "WITH " + ",\n".join(subs) + f", spine AS ({spine}), wide AS (SELECT * FROM spine {joins}) SELECT player, {kept.removesuffix(', ')}{others if kept else others.removeprefix(', ')} FROM wide"


def _oracle_per_player(name: str, window: Window) -> str:
    if name == "var10j":
        tables, classes = oracle_order(("risk",)), ("HIGH", "LOW", "NO_RISK")  # fixed values: the classes that the adapter makes
        picks = ", ".join(f"CAST(bool_or(class = '{c}') AS BIGINT) AS var10j_rg_{c}" for c in classes)
        return "WITH " + ", ".join(f"{b} AS ({ORACLE_CTES[b]})" for b in tables) + f" SELECT player, {picks} FROM risk GROUP BY player"
    if name in _WIDENED:
        by, values, columns = _WIDENED[name]
        picks = ", ".join(f"max({c}) FILTER ({by} = '{v}') AS {name}_{v.lower()}_{c}" for v in values for c in columns)
        return f"SELECT player, {picks} FROM ({oracle(name, window)}) GROUP BY player"
    return oracle(name, window)


def stats_row(df: DataFrame) -> DataFrame:
    """Mean, sample deviation, least and largest of every numeric column, in one row."""
    cols = [c for c, t in df.dtypes if c != "player" and t in ("double", "bigint", "int", "float")]
    return df.agg(*(F.round(fn(F.col(c).cast("double")), 6).alias(f"{c}_{n}") for c in cols for n, fn in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))))

"""Feature semantics on literal rows."""

import pytest

from wagerlens.plans import engine
from wagerlens.plans.engine import SCENARIOS, FeatureContext, stats_row
from wagerlens.plans.features import DAY_US, FEATURES, VIEWS, Window, compose, month_edges, needed
from wagerlens.plans.engine import numbers

W = Window(100, 110)
H = 3_600_000_000
TX = "player long, tx_id long, operator long, us long, dayno long, hour long, dow long, type string, status string, amount double, instrument string, k long"
EMPTY = {
    "bet": "pk long, operator long, bet_id long, us long, status string, extracted_us long, stake double, hour long",
    "bet_link": "pk long, player long, tx_id long",
    "leg": "pk long, part_id long, event string, sport string, odds double, live string",
    "ses": "pk long, operator long, session_id long, us long, game_id long, rounds long, hour long, end_us long",
    "ses_link": "pk long, player long, tx_id long",
    "game": "game_id long, type string, name string",
    "prof": "player long, pk long, operator long, modified_us long, extracted_us long, status string, eod_balance double, dob long",
    "lim": "player long, kind string, us long, value double, span string",
    "club": "club string, country int",
    "account": "player long, account string",
    "risk": "player long, class string",
    "complaint": "row_id long, player long, complaint_id string, us long",
    "response": "row_id long, response_id string",
    "contact": "player long, us long",
}


def tx(i, at, kind, amount, player=1, status="SUCCESSFUL"):
    """A movement at ``at`` hours after the window's start."""
    us = 100 * DAY_US + int(at * H)
    return (player, i, 0, us, us // DAY_US, us // H % 24, (us // DAY_US + 3) % 7, kind, status, float(amount), "CREDIT_CARD", 1)


@pytest.fixture
def make(spark):
    def run(name, rows, columns=None, **tables):
        frames = {k: spark.createDataFrame(tables.get(k, []), schema) for k, schema in EMPTY.items()}
        frames["tx"] = spark.createDataFrame(rows, TX)
        got = {r[0]: tuple(r[1:]) for r in FeatureContext(frames, W).feature(name).collect()}
        return {k: v[0] if len(v) == 1 else v for k, v in got.items()}

    return run


def test_signs_windows_and_days(make):
    rows = [tx(1, 0, "STAKE", 10), tx(2, 1, "WINNING", 4), tx(3, 30, "STAKE", 5), tx(4, 31, "VOID_BET", 5), tx(5, -1, "STAKE", 99), tx(6, 240, "STAKE", 99), tx(7, 5, "STAKE", 3, status="UNSUCCESSFUL"), tx(8, 50, "OTHER", 8)]
    assert make("f0", rows) == {1: 24.0}
    assert make("f1", rows) == {1: 2}
    assert make("f2", rows) == {1: 12.0}
    assert make("f3", rows) == {1: -10.0}
    assert make("f4", rows) == {1: -5.0}
    assert make("f7", rows) == {1: 0.55}
    assert make("f14", rows) == {1: 3}
    assert make("f57", rows) == {1: 3}


def test_ratios_without_active_days_are_unknown(make):
    rows = [tx(1, 0, "DEPOSIT", 10), tx(2, 0, "STAKE", 10, player=2)]
    assert make("f12", rows) == {1: None, 2: 0.0}
    assert make("f2", rows) == {2: 10.0}


def test_balance_moments_group_equal_times(make):
    prof = [(1, 1, 0, 0, 100 * DAY_US, "ACTIVE", 10.0, 19900101)]
    rows = [tx(1, 12, "STAKE", 9), tx(2, 12, "DEPOSIT", 10), tx(3, 13, "WITHDRAWAL", 1)]
    assert make("f26", rows, prof=prof) == {1: 0.0}
    rows = [tx(1, 12, "STAKE", 9), tx(2, 13, "DEPOSIT", 3), tx(3, 13, "DEPOSIT", 5)]
    assert make("f26", rows, prof=prof) == {1: 1.0}
    assert make("f27", rows, prof=prof) == {1: 2.0}
    assert make("f28", rows, prof=prof) == {1: 3600.0}
    two = [*prof, (1, 2, 0, 0, 100 * DAY_US, "ACTIVE", 11.0, 19900101)]
    assert make("f26", rows, prof=two) == {1: None}  # two balances at one time


def test_net_stakes_follow_refunds(make):
    link = [(7, 1, 1), (7, 1, 2), (7, 1, 3)]
    rows = [tx(1, 9, "STAKE", 10), tx(2, 17, "STAKE", 30), tx(3, 18, "VOID_BET", 20)]
    assert make("f44", rows, bet_link=link) == {1: 0.25}
    assert make("f45", rows, bet_link=link) == {1: 0.75}
    assert make("f44", [*rows, tx(4, 19, "VOID_BET", 1)], bet_link=link) == {1: None}  # a refund of no known stake


def test_next_bet_is_strictly_later(make):
    at = 100 * DAY_US
    bets = [(1, 0, 1, at + H, "BET_SETTLED", at + 2 * H, 5.0, 1), (2, 0, 2, at + 2 * H, "BET_PLACED", at + 9 * H, 5.0, 2), (3, 0, 3, at + 4 * H, "BET_PLACED", at + 9 * H, 5.0, 4)]
    link = [(1, 1, 1), (2, 1, 2), (3, 1, 3)]
    rows = [tx(1, 1, "STAKE", 5), tx(2, 2, "STAKE", 5), tx(3, 4, "STAKE", 5)]
    assert make("f51", rows, bet=bets, bet_link=link) == {1: 7200.0}
    # a prize, even a later one, is no loss; nor is an unreadable or negative prize known to be none
    for amount in (3, -1):
        assert make("f51", [*rows, tx(4, 5, "WINNING", amount)], bet=bets, bet_link=[*link, (1, 1, 4)]) == {1: None}
    # a refund closes the bet at its own time
    assert make("f51", [*rows, tx(4, 3, "VOID_BET", 5)], bet=bets, bet_link=[*link, (1, 1, 4)]) == {1: 3600.0}
    # players whose bets have no parent stay, unknown
    assert make("f51", rows, bet=[], bet_link=link) == {1: None}
    # a movement before the placement, or one that may belong to two bets, leaves the outcome unknown
    assert make("f51", [*rows, tx(4, 0.5, "WINNING", 0)], bet=bets, bet_link=[*link, (1, 1, 4)]) == {1: None}
    assert make("f51", rows, bet=bets, bet_link=[*link, (2, 1, 1)]) == {1: None}
    # the last version counts: two statuses at one time are none, a newer one settles it
    both = [*bets, (4, 0, 1, at + H, "BET_CANCELLED", at + 2 * H, 5.0, 1)]
    assert make("f51", rows, bet=both, bet_link=link) == {1: None}
    assert make("f51", rows, bet=[*both, (5, 0, 1, at + H, "bet_settled ", at + 3 * H, 5.0, 1)], bet_link=link) == {1: 7200.0}


def test_segments_take_every_loss(make):
    rows = [tx(1, 1, "STAKE", 10), tx(2, 1, "BONUS_EXPIRED", -100), tx(3, 1, "BONUS", 500)]
    assert make("f33", rows, bet_link=[(1, 1, 1)]) == {1: 0}
    assert make("f38", rows, bet_link=[(1, 1, 1)]) == {1: 1}
    assert make("f33", rows[:1], bet_link=[(1, 1, 1)]) == {1: 1}


def test_countries_and_domestic_bets(make):
    at = 100 * DAY_US
    bets = [(k, 0, k, at, "BET_PLACED", at, 5.0, 1) for k in (1, 2, 3)]
    leg = [(1, 1, "Ajax - PSV", "Voetbal", 2.0, "0"), (2, 1, "Lyon - Ajax 2", "tennis", 2.0, "0"), (3, 1, "Lyon - Nice", "SOCCER", 2.0, "0")]
    clubs = [("Ajax", 3), ("LYON", 5), ("psv", 3)]
    link = [(1, 1, 1), (1, 1, 2), (3, 1, 3), (2, 2, 4)]
    assert make("f17", [], bet=bets, bet_link=link, leg=leg, club=clubs) == {1: 2, 2: 2}
    assert make("f17", [], bet=bets, bet_link=link, leg=leg) == {1: None, 2: None}
    assert make("f20", [], bet=bets, bet_link=link, leg=leg, club=clubs) == {1: 0.666667}


def test_months_of_exclusion(make):
    month = {name: lo for name, lo, _ in month_edges()}
    prof = [(1, k, 0, month[m] + 5, 0, s, 0.0, 19900101) for k, (m, s) in enumerate([("2023_08", "SELF_EXCLUDED_TEMP"), ("2023_09", "SELF_EXCLUDED_INDEF"), ("2023_11", "BLOCKED"), ("2025_07", "SELF_EXCLUDED_TEMP")])]
    prof += [(2, 1, 0, month["2024_02"], 0, "TRIAL", 0.0, 19900101), (3, 1, 0, month["2023_08"] - 1, 0, "BLOCKED", 0.0, 19900101)]
    got = make("monthly_exclusion", [], prof=prof)
    names = [f"{c}_{m}" for m in month for c in "abcd"]
    assert {n for n, v in zip(names, got[1], strict=True) if v} == {"a_2023_08", "b_2023_08", "a_2023_09", "c_2023_09", "d_2023_11", "a_2025_07", "b_2025_07", "c_2025_07"}
    assert set(got) == {1, 2} and not any(got[2])


def test_an_exclusion_sticks_to_the_next_status(make):
    def line(*statuses):
        return [(1, k, 0, 0, k, s, 0.0, 19900101) for k, s in enumerate(statuses)]

    assert make("ever_excluded", [], prof=line("SELF_EXCLUDED_TEMP", "ACTIVE"))[1] == (1, "ACTIVE", 1, 2, 1, 1)
    assert make("ever_excluded", [], prof=line("SELF_EXCLUDED_TEMP", "ACTIVE", "ACTIVE"))[1] == (0, "ACTIVE", 2, 3, 1, 0)
    assert make("ever_excluded", [], prof=line("ACTIVE", "BLOCKED"))[1] == (0, "BLOCKED", 1, 2, 0, None)


def test_complaints_and_windows(make):
    at = 101 * DAY_US
    complaint = [(1, 1, "a", at), (2, 1, "b", at), (3, 1, "b", 0), (4, 2, "c", None)]
    response = [(1, "x"), (1, "y"), (2, "x"), (3, "x")]
    assert make("complaint_variance", [], complaint=complaint, response=response) == {1: (2, 0.5), 2: (1, 0.0)}
    assert make("var11", [], complaint=complaint) == {1: 2}
    assert make("var16", [], complaint=complaint, response=response) == {1: 3}
    rows = [tx(1, 1, "DEPOSIT", 5), tx(2, 30, "DEPOSIT", 9), tx(3, 40, "STAKE", 1, status="UNSUCCESSFUL"), tx(4, -5, "STAKE", 1, player=2)]
    prof = [(3, 1, 0, at, 0, "SELF_EXCLUDED_TEMP", 0.0, 19900101)]
    assert make("flexible_x", rows, prof=prof) == {1: (2, 2, 1.0, 0, 8.0, -14.0), 2: (None,) * 6, 3: (0, 0, 0.0, 1, 0.0, 0.0)}


def test_suspensions_count_entries_and_conflicts_are_unknown(make):
    d = DAY_US
    prof = [(1, k, 0, k * d, k * d, s, 0.0, 19900101) for k, s in enumerate(["ACTIVE", "SELF_EXCLUDED_TEMP", "SELF_EXCLUDED_INDEF", "ACTIVE", "SELF_EXCLUDED_TEMP"])]
    prof += [(2, 1, 0, d, d, "ACTIVE", 0.0, 19900101), (2, 2, 0, d, d, "BLOCKED", 0.0, 19900101)]
    assert make("f25", [], prof=prof) == {1: 2, 2: None}


def test_longest_streak_and_gaps(make):
    rows = [tx(k, h, "STAKE", 1) for k, h in enumerate([0, 25, 49, 120, 125])]
    assert make("f57", rows) == {1: 3}
    assert make("f58", rows) == {1: 0.75}
    assert make("f59", rows) == {1: 5.0}


def test_limits_compare_with_the_previous_of_their_kind(make):
    at = 101 * DAY_US
    S = 1_000_000
    lim = [(1, "DEPOSIT", at, 10.0, "DAY"), (1, "DEPOSIT", at + S, 20.0, "DAY"), (1, "DEPOSIT", at + 2 * S, 5.0, "DAY"), (1, "LOGIN", at + 3 * S, 99.0, "DAY"), (2, "PARTICIPATION", at, 1.0, "DAY"), (2, "DEPOSIT", at + S, 1.0, "DAY"), (2, "DEPOSIT", at + 2 * S, 9.0, "DAY")]
    assert make("f22", [], lim=lim) == {1: 1, 2: 0}
    assert make("f23", [], lim=lim) == {1: 1, 2: 0}
    # one second, one event; spans in both spellings; participation without a span and game types don't count
    lim = [(1, "PARTICIPATION", at, 5.0, "day"), (1, "PARTICIPATION", at + S, 9.0, "DAILY"), (1, "PARTICIPATION", at + S + 7, 10.0, "DAY"), (1, "PARTICIPATION", at + 2 * S, 99.0, None)]
    lim += [(2, "PARTICIPATION", at, 5.0, None), (2, "BALANCE", at, 1.0, None), (2, "BALANCE", at + 5 * S, 2.0, None), (2, "GAME_TYPE", at, 1.0, None), (2, "GAME_TYPE", at + S, 2.0, None)]
    assert make("f22", [], lim=lim) == {1: 1, 2: 1}


def test_latest_limits_take_unknown_last_where_times_tie(spark):
    rows = [(1, "LOGIN", 5, 2.0, None), (1, "LOGIN", 5, 2.0, "WEEK"), (1, "LOGIN", 4, 1.0, "DAY"), (1, "DEPOSIT", 5, None, "DAY"), (1, "DEPOSIT", 5, 7.0, None), (2, "GAME_TYPE", 5, None, None), (2, "GAME_TYPE", 5, None, "DAY"), (3, "LOGIN", None, 1.0, "DAY"), (3, "LOGIN", 1, 9.0, "DAY")]
    frames = {k: spark.createDataFrame([], schema) for k, schema in EMPTY.items()} | {"lim": spark.createDataFrame(rows, EMPTY["lim"])}
    got = {tuple(r) for r in FeatureContext(frames, W).feature("latest_limits").collect()}
    duckdb = pytest.importorskip("duckdb").connect()
    duckdb.execute("CREATE TABLE lim (player BIGINT, kind VARCHAR, us BIGINT, value DOUBLE, span VARCHAR)")
    duckdb.executemany("INSERT INTO lim VALUES (?, ?, ?, ?, ?)", rows)
    assert got == set(duckdb.execute(compose("latest_limits", numbers(W), "duckdb")[1]).fetchall())
    assert got == {(1, "LOGIN", 2.0, "WEEK"), (1, "DEPOSIT", 7.0, None), (2, "GAME_TYPE", None, "DAY"), (3, "LOGIN", 9.0, "DAY")}


def test_every_plan_names_known_tables_and_composes():
    for name in [*FEATURES, *VIEWS]:
        plans, base = needed(name)
        assert base or plans, name
        for engine in ("spark", "duckdb"):
            plans, sql, _ = compose(name, numbers(W), engine)
            assert "{" not in (plans + sql).replace("{'club'", ""), name


def test_partitioning_does_not_change_results(spark):
    rows = [tx(k, (k * 7919) % 230, ["STAKE", "WINNING", "DEPOSIT", "WITHDRAWAL"][k % 4], k % 13 + 1, player=k % 5) for k in range(400)]
    frames = {k: spark.createDataFrame([], schema) for k, schema in EMPTY.items()}
    got = []
    for n in (1, 7):
        frames["tx"] = spark.createDataFrame(rows[:: 1 if n == 1 else -1], TX).repartition(n)
        ctx = FeatureContext(frames, W)
        got.append([sorted(map(tuple, ctx.feature(f).collect())) for f in ("f0", "f53", "f56", "f59", "var20")])
    assert got[0] == got[1]


def test_no_query_of_a_wide_scenario_joins_many_frames(spark, tmp_path, monkeypatch):
    frames = [spark.createDataFrame([(i, float(i)), (99, 1.0)], f"player long, c{i} double") for i in range(20)]
    monkeypatch.setattr(engine, "shared_folder", lambda _: f"file://{tmp_path}")
    out = engine.side_by_side(frames)
    # a join sorts each of its frames: the memory of a task would grow with the features
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") <= engine.JOINED
    assert out.columns == ["player", *(f"c{i}" for i in range(20))]
    got = {r.player: r[1:] for r in out.collect()}
    assert got.pop(99) == (1.0,) * 20
    assert got == {i: tuple(float(i) if k == i else None for k in range(20)) for i in range(20)}


def test_scenario_fills_and_stats(spark):
    frames = {k: spark.createDataFrame([], schema) for k, schema in EMPTY.items()}
    frames["tx"] = spark.createDataFrame([tx(1, 0, "STAKE", 10), tx(2, 0, "DEPOSIT", 10, player=2)], TX)
    out = {r.player: r for r in FeatureContext(frames, W).scenario("balance_probe").collect()}
    assert out[1].f0_net_winloss == 10 and out[1].f26_balance_drop_frequency is None
    assert set(SCENARIOS["core"]) <= set(FEATURES)
    row = stats_row(spark.createDataFrame([(1, 2.0), (2, 4.0)], "player long, x double")).first()
    assert (row.x_mean, row.x_min, row.x_max) == (3.0, 2.0, 4.0)

"""Oracle queries in DuckDB's SQL that share no text with the plans they check.

They say what a feature means in another way: correlated look-ups where a plan has
windows, calendar functions where it has numbers, one set per segment where it groups.
"""

from __future__ import annotations

from datetime import date, timedelta

from wagerlens.plans.features import Window

_DAY = 86_400_000_000


def _bounds(window: Window) -> dict[str, int]:
    return {"x0": window.first_day * _DAY, "x1": window.last_day * _DAY}


def _limits(sign: str, name: str) -> str:
    """Every event beside the latest earlier one of its stream; equal times in order of value."""
    return f"""
    e AS (SELECT player, kind, value, us - us % 1000000 AS sec, CASE WHEN kind = 'PARTICIPATION' THEN replace(replace(replace(span, 'DAILY', 'DAY'), 'WEEKLY', 'WEEK'), 'MONTHLY', 'MONTH') ELSE span END AS span FROM lim
        WHERE value IS NOT NULL AND kind <> 'GAME_TYPE' AND NOT (kind = 'PARTICIPATION' AND span IS NULL)),
    w AS (SELECT *, row_number() OVER () AS i FROM e WHERE sec BETWEEN {{x0}} AND {{x1}} - 1),
    own AS (SELECT * FROM w WHERE kind = 'PARTICIPATION' OR player NOT IN (SELECT player FROM w WHERE kind = 'PARTICIPATION')),
    steps AS (SELECT a.player, a.sec, a.value, (SELECT arg_max(b.value, (b.sec, b.value, b.i)) FROM own b WHERE b.player = a.player AND b.kind = a.kind AND b.span IS NOT DISTINCT FROM a.span AND (b.sec, b.value, b.i) < (a.sec, a.value, a.i)) AS prior FROM own a)
    SELECT player, count(DISTINCT sec) FILTER (value {sign} prior) AS {name} FROM steps GROUP BY player"""


def _segment(name: str, chosen: str) -> str:
    return f"""
    moved AS (SELECT player, tx_id, -(CASE WHEN type = 'STAKE' THEN -abs(amount) ELSE amount END) AS wager FROM tx WHERE us >= {{x0}} AND us < {{x1}} AND status = 'SUCCESSFUL'),
    paid AS (SELECT * FROM moved WHERE wager > 0),
    of_session AS (SELECT l.tx_id, max(g.type) AS type FROM ses_link l, ses s, game g WHERE l.pk = s.pk AND s.game_id = g.game_id GROUP BY l.tx_id),
    placed AS (SELECT player, wager, CASE WHEN tx_id IN (SELECT tx_id FROM bet_link) THEN 'BET' WHEN (SELECT type FROM of_session o WHERE o.tx_id = p.tx_id) IN ('SLOTS', 'CASINO', 'BINGO', 'VIRTUAL_SPORTS') THEN (SELECT type FROM of_session o WHERE o.tx_id = p.tx_id) ELSE 'OTHER' END AS segment FROM paid p),
    active AS (SELECT DISTINCT player FROM tx WHERE us >= {{x0}} AND us < {{x1}} AND type = 'STAKE')
    SELECT player, CAST(coalesce((SELECT sum(wager) FILTER (segment = '{chosen}') / sum(wager) >= 0.7 FROM placed q WHERE q.player = a.player), false) AS BIGINT) AS {name} FROM active a"""


_CLUBS = "EXISTS (SELECT 1 FROM club c WHERE {where} instr(upper(g.event), upper(c.club)) > 0)"

_WINDOWED = """
    dep AS (SELECT player, abs(amount) AS v FROM tx WHERE us >= {lo} AND us < {hi} AND status = 'SUCCESSFUL' AND type = 'DEPOSIT'),
    days AS (SELECT DISTINCT player, dayno FROM tx WHERE us >= {lo} AND us < {hi} AND status = 'SUCCESSFUL'),
    rows_ AS (SELECT player, status FROM prof WHERE modified_us >= {lo} AND modified_us < {hi}),
    known AS (SELECT player FROM days UNION SELECT player FROM rows_),
    everyone AS ({everyone})
    SELECT e.player, {picks} FROM everyone e LEFT JOIN known k ON e.player = k.player"""


def _windowed(prefix: str, lo: str, hi: str, every: bool) -> str:
    known = {
        "deposits": "(SELECT count(*) FROM dep d WHERE d.player = e.player)",
        "active_days": "(SELECT count(*) FROM days d WHERE d.player = e.player)",
        "active_days_per_deposit": "round(coalesce((SELECT count(*) FROM days d WHERE d.player = e.player) / nullif((SELECT CAST(count(*) AS DOUBLE) FROM dep d WHERE d.player = e.player), 0), 0), 6)",
        "temp_exclusions": "(SELECT count(*) FROM rows_ r WHERE r.player = e.player AND r.status = 'SELF_EXCLUDED_TEMP')",
        "deposit_variance": "round(coalesce((SELECT (sum(v * v) - sum(v) * sum(v) / count(*)) / nullif(count(*) - 1, 0) FROM dep d WHERE d.player = e.player), 0), 6)",
        "withdrawn_less_deposited": f"round(coalesce((SELECT sum(abs(amount)) FROM tx t WHERE t.player = e.player AND us >= {lo} AND us < {hi} AND status = 'SUCCESSFUL' AND type = 'WITHDRAWAL'), 0) - coalesce((SELECT sum(v) FROM dep d WHERE d.player = e.player), 0), 6)",
    }
    picks = ", ".join(f"CASE WHEN k.player IS NOT NULL THEN {v} END AS {prefix}_{n}" for n, v in known.items())
    return _WINDOWED.format(lo=lo, hi=hi, picks=picks, everyone="SELECT player FROM tx UNION SELECT player FROM prof" if every else "SELECT player FROM known")


def _bitmaps() -> str:
    """Months by the calendar; the runs' edges by looking at the months beside."""
    picks = []
    months = [date(2023 + (7 + k) // 12, (7 + k) % 12 + 1, 1) for k in range(24)]
    for k, m in enumerate(months):
        name, here = f"{m:%Y_%m}", f"list_contains(o, '{m:%Y-%m}')"
        before = f"list_contains(o, '{months[k - 1]:%Y-%m}')" if k else "false"
        after = f"list_contains(o, '{months[k + 1]:%Y-%m}')" if k < 23 else "false"
        picks += [f"CAST({x} AS BIGINT) AS y_2{c}_{name}_{w}" for c, w, x in (("a", "observed", here), ("b", "start", f"{here} AND NOT {before}"), ("c", "end", f"{here} AND NOT {after}"), ("d", "uncertain", f"list_contains(u, '{m:%Y-%m}')"))]
    return f"""
    m AS (SELECT player, status, strftime(make_timestamp(modified_us), '%Y-%m') AS month FROM prof),
    per AS (SELECT player, coalesce(list(month) FILTER (status IN ('SELF_EXCLUDED_TEMP', 'SELF_EXCLUDED_INDEF')), []) AS o, coalesce(list(month) FILTER (status IN ('SUSPENDED', 'SUSPENDED_DEATH', 'BLOCKED', 'OTHER')), []) AS u FROM m WHERE month BETWEEN '2023-08' AND '2025-07' GROUP BY player)
    SELECT player, {', '.join(picks)} FROM per"""


_EXCLUDED = "('SELF_EXCLUDED_TEMP', 'SELF_EXCLUDED_INDEF')"
_STATUS = ("active", "trial", "suspended", "suspended_death", "blocked", "self_excluded_temp", "self_excluded_indef", "other")


def _us(day: date) -> str:
    return str((day - date(1970, 1, 1)) // timedelta(microseconds=1))


#: name: (tables, common table expressions and query)
_BODIES: dict[str, tuple[tuple[str, ...], str]] = {
    "f17": (
        ("bet", "bet_link", "leg", "club"),
        "pairs AS (SELECT DISTINCT l.player, c.country FROM bet b JOIN bet_link l ON b.pk = l.pk JOIN leg g ON b.pk = g.pk LEFT JOIN club c ON instr(upper(g.event), upper(c.club)) > 0 WHERE b.us >= {x0} AND b.us < {x1}) SELECT player, CASE WHEN count(country) > 0 THEN count(country) END AS f17_number_of_bet_countries FROM pairs GROUP BY player",
    ),
    "f20": (
        ("bet", "bet_link", "leg", "club"),
        "legs AS (SELECT g.pk, "
        + _CLUBS.format(where="c.country = 3 AND")
        + " AS home FROM leg g WHERE lower(g.sport) IN ('football', 'voetbal', 'fussball', 'calcio', 'futbol', 'soccer') AND g.pk IN (SELECT pk FROM bet WHERE us >= {x0} AND us < {x1})), per AS (SELECT pk, bool_or(home) AS home FROM legs GROUP BY pk) SELECT l.player, round(count(*) FILTER (home) / CAST(count(*) AS DOUBLE), 6) AS f20_domestic_bets_pct FROM per JOIN bet_link l USING (pk) GROUP BY l.player",
    ),
    "f22": (("lim",), _limits(">", "f22_limit_increases")),
    "f23": (("lim",), _limits("<", "f23_limit_decreases")),
    **{f"f{k}": (("tx", "bet_link", "ses_link", "ses", "game"), _segment(f"f{k}_70_{name}", chosen)) for k, name, chosen in ((33, "bets", "BET"), (34, "slots", "SLOTS"), (35, "casino", "CASINO"), (36, "bingo", "BINGO"), (37, "virtual_sports", "VIRTUAL_SPORTS"), (38, "other", "OTHER"))},
    "f51": (
        ("tx", "bet", "bet_link"),
        """refs AS (SELECT DISTINCT b.operator, b.bet_id, l.player, l.tx_id FROM bet_link l, bet b WHERE l.pk = b.pk),
    moved AS (SELECT t.*, (SELECT count(*) FROM refs r WHERE r.player = t.player AND r.tx_id = t.tx_id AND r.operator = t.operator) AS n FROM tx t WHERE t.us < {x1} AND t.status = 'SUCCESSFUL'),
    bets AS (SELECT operator, bet_id, min(us) FILTER (us < {x1}) AS placed, min(extracted_us) FILTER (status = 'BET_SETTLED' AND extracted_us < {x1}) AS settled, max(extracted_us) FILTER (extracted_us < {x1}) AS newest FROM bet GROUP BY ALL),
    last_ AS (SELECT b.operator, b.bet_id, any_value(v.status) AS status FROM bets b JOIN bet v ON v.operator = b.operator AND v.bet_id = b.bet_id AND v.extracted_us = b.newest GROUP BY ALL HAVING count(DISTINCT v.status) = 1),
    outcome AS (SELECT r.operator, r.bet_id, r.player, b.placed, bool_or(m.type = 'STAKE' AND m.amount <> 0 AND m.n = 1 AND m.us >= b.placed) AS stake,
        bool_or(m.type IN ('STAKE', 'WINNING', 'CASH_OUT', 'VOID_BET') AND (m.n > 1 OR m.us < b.placed)) OR bool_or(m.type = 'CASH_OUT') OR bool_or(m.type = 'WINNING' AND m.amount <> 0) AS out_,
        min(m.us) FILTER (m.type = 'VOID_BET' AND m.amount <> 0 AND m.n = 1 AND m.us >= b.placed) AS void_at, any_value(b.settled) AS settled
        FROM refs r JOIN bets b USING (operator, bet_id) JOIN moved m ON m.player = r.player AND m.tx_id = r.tx_id AND m.operator = r.operator GROUP BY ALL),
    closed AS (SELECT o.operator, o.player, o.placed, coalesce(o.void_at, CASE WHEN l.status = 'BET_SETTLED' THEN o.settled END) AS ended FROM outcome o LEFT JOIN last_ l USING (operator, bet_id) WHERE stake AND NOT out_),
    waits AS (SELECT player, (SELECT min(o.placed) FROM outcome o WHERE o.operator = c.operator AND o.player = c.player AND o.stake AND o.placed >= {x0} AND o.placed > c.ended) - ended AS wait FROM closed c WHERE ended >= placed AND ended >= {x0})
    SELECT player, (SELECT median(CAST(wait AS DOUBLE)) FROM waits w WHERE w.player = p.player) / 1e6 AS f51_median_seconds_loss_to_next_bet FROM (SELECT DISTINCT player FROM bet_link) p""",
    ),
    "flexible_x": (("tx", "prof"), _windowed("x", "{x0}", "{x1}", True)),
    "april_may": (("tx", "prof"), _windowed("x_am", _us(date(2025, 4, 1)), _us(date(2025, 6, 1)), False)),
    "june_july": (("prof",), "p AS (SELECT player, status FROM prof WHERE make_timestamp(modified_us) >= TIMESTAMP '2025-06-01' AND make_timestamp(modified_us) < TIMESTAMP '2025-08-01') SELECT player, CAST(bool_or(status IN " + _EXCLUDED + ") AS BIGINT) AS y_self_exclusion_june_july FROM p GROUP BY player"),
    "monthly_exclusion": (("prof",), _bitmaps()),
    "ever_excluded": (
        ("prof",),
        f"""kept AS (SELECT player, extracted_us AS told, arg_min(status, pk) AS status FROM prof GROUP BY ALL),
    ends AS (SELECT player, list(status ORDER BY told DESC) AS line, max(told) AS told FROM kept GROUP BY player),
    known AS (SELECT player, line[1] AS status, told, CAST(line[1] IN {_EXCLUDED} OR coalesce(line[2] IN {_EXCLUDED}, false) AS BIGINT) AS y, (SELECT count(*) FROM prof p WHERE p.player = e.player) AS n FROM ends e)
    SELECT player, y AS y_1b_ever_excluded, status AS y_1c_last_status, told AS y_1d_extracted_us, n AS y_1x_profiles, CAST(status IN ('ACTIVE', 'SELF_EXCLUDED_TEMP', 'SELF_EXCLUDED_INDEF') AS BIGINT) AS y_1e_certain, if(status IN ('ACTIVE', 'SELF_EXCLUDED_TEMP', 'SELF_EXCLUDED_INDEF'), y, NULL) AS y_1_final FROM known""",
    ),
    "var10": (
        ("prof",),
        "seen AS (SELECT player, list(DISTINCT lower(status)) AS s FROM prof WHERE modified_us >= {x0} AND modified_us < {x1} GROUP BY player) SELECT player, " + ", ".join(f"CAST(list_contains(s, '{x}') AS BIGINT) AS var10{c}_{x}" for c, x in zip("abcdefgh", _STATUS, strict=True)) + " FROM seen",
    ),
    "var14": (
        ("ses", "ses_link"),
        """one AS (SELECT DISTINCT l.player, s.pk, s.rounds, CASE WHEN s.end_us >= s.us THEN (s.end_us - s.us) / 1e6 END AS took FROM ses s JOIN ses_link l ON l.pk = s.pk WHERE s.us >= {x0} AND s.us < {x1})
    SELECT player, count(*) AS var14a_sessions, CAST(sum(rounds) AS BIGINT) AS var14b_rounds, round(sum(took) / count(took), 6) AS var14c_mean_session_seconds, round(coalesce(sum(took), 0), 6) AS var14d_session_seconds FROM one GROUP BY player""",
    ),
    "var16": (
        ("complaint", "response"),
        "w AS (SELECT * FROM complaint WHERE us >= {x0} AND us < {x1}) SELECT w.player, CAST(sum((SELECT count(*) FROM response r WHERE r.row_id = w.row_id)) AS BIGINT) AS var16_responses FROM w GROUP BY w.player",
    ),
    "complaint_variance": (
        ("complaint", "response"),
        """n AS (SELECT c.player, c.complaint_id, CAST(count(DISTINCT r.response_id) AS DOUBLE) AS n FROM complaint c LEFT JOIN response r USING (row_id) GROUP BY ALL)
    SELECT player, count(*) AS number_of_complaints, round(CASE WHEN count(*) > 1 THEN (sum(n * n) - sum(n) * sum(n) / count(*)) / (count(*) - 1) ELSE 0 END, 6) AS variance_in_number_of_responses_per_complaint FROM n GROUP BY player""",
    ),
}


def independent(name: str, window: Window) -> tuple[tuple[str, ...], str] | None:
    """(tables, text) of the oracle that says the feature in its own words, if there is one."""
    if name not in _BODIES:
        return None
    tables, text = _BODIES[name]
    for k, v in _bounds(window).items():
        text = text.replace("{" + k + "}", str(v))
    return tables, text

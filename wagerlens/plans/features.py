"""Feature plans: one declarative query per feature over the domain tables.

A plan names the tables and other plans that it reads; ``compose`` puts them in front as
common table expressions, each once, so Catalyst sees one query per feature or scenario
and prunes, pushes down and reuses as it sees fit. Time is in the integer columns of
``sources.domain``. Windows are half-open, [x0, x1) in UTC microseconds; days and hours
are civil ones. Where the order of rows matters it is (us, tx_id).
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date

DAY_US = 86_400_000_000

#: Statuses of profiles, names of football and spans of limits.
STATUSES = ("ACTIVE", "TRIAL", "SUSPENDED", "SUSPENDED_DEATH", "BLOCKED", "SELF_EXCLUDED_TEMP", "SELF_EXCLUDED_INDEF", "OTHER")
EXCLUDED = ("SELF_EXCLUDED_TEMP", "SELF_EXCLUDED_INDEF")
UNCERTAIN = ("SUSPENDED", "SUSPENDED_DEATH", "BLOCKED", "OTHER")
FOOTBALL = ("FOOTBALL", "VOETBAL", "FUSSBALL", "CALCIO", "FUTBOL", "SOCCER")
#: Months of the exclusion bitmaps: the first one and their number.
FIRST_MONTH, MONTHS = (2023, 8), 24


def day_number(year: int, month: int, day: int = 1) -> int:
    """Days since the epoch."""
    return (date(year, month, day) - date(1970, 1, 1)).days


def month_edges() -> list[tuple[str, int, int]]:
    """(name, first microsecond, first microsecond after) of every month of the bitmaps."""
    first = FIRST_MONTH[0] * 12 + FIRST_MONTH[1] - 1
    starts = [(k // 12, k % 12 + 1) for k in range(first, first + MONTHS + 1)]
    return [(f"{y}_{m:02d}", day_number(y, m) * DAY_US, day_number(*after) * DAY_US) for (y, m), after in zip(starts, starts[1:], strict=False)]


def _in(values: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


@dataclass(frozen=True)
class Window:
    """A half-open window of UTC days, given as days since the epoch."""

    first_day: int
    last_day: int

    @property
    def names(self) -> dict[str, int]:
        x0, x1 = self.first_day * DAY_US, self.last_day * DAY_US
        return {"x0": x0, "x1": x1, "x1_incl": x1 + DAY_US, "n_days": self.last_day - self.first_day}


def _r(x: str) -> str:
    return f"round(CAST({x} AS DOUBLE), 6)"


_NET = "('WINNING', 'CASH_OUT', 'VOID_BET', 'VOID_STAKE', 'BONUS', 'STAKE', 'BONUS_CANCELLED', 'BONUS_EXPIRED', 'RESETTLEMENT')"
_OK = "status = 'SUCCESSFUL'"
_SIGNED = "CASE WHEN type = 'STAKE' THEN -abs(amount) WHEN type IN ('WITHDRAWAL') THEN -abs(amount) ELSE amount END"

#: Shared sub-plans.
VIEWS: dict[str, str] = {
    "txw": "SELECT * FROM tx WHERE us >= {x0} AND us < {x1}",
    "betw": "SELECT * FROM bet WHERE us >= {x0} AND us < {x1}",
    "sesw": "SELECT * FROM ses WHERE us >= {x0} AND us < {x1}",
    "bet_player": "SELECT DISTINCT pk, player FROM bet_link",
    "ses_player": "SELECT DISTINCT pk, player FROM ses_link",
    "active_player": "SELECT DISTINCT player FROM txw",
    # stakes in order, with their place and half; the lower half holds the middle one
    "stake_line": """SELECT *, CASE WHEN place <= (n - 1) / 2.0 THEN 1 ELSE 2 END AS half FROM (
        SELECT player, us, tx_id, dayno, abs(amount) AS stake, row_number() OVER (PARTITION BY player ORDER BY us, tx_id) - 1 AS place, count(*) OVER (PARTITION BY player) AS n
        FROM txw WHERE type = 'STAKE' AND status = 'SUCCESSFUL') s""",
    "days": "SELECT DISTINCT player, dayno FROM txw",
    "islands": "SELECT player, min(dayno) AS first_day, max(dayno) AS last_day, count(*) AS n FROM (SELECT player, dayno, dayno - row_number() OVER (PARTITION BY player ORDER BY dayno) AS g FROM days) d GROUP BY player, g",
    # opening balance: the latest snapshot up to x0, else the earliest inside the window, bridged by the movements between
    "snapshots": """SELECT player, extracted_us AS us, min(eod_balance) AS balance, count(DISTINCT eod_balance) AS versions FROM prof WHERE extracted_us < {x1} GROUP BY player, extracted_us""",
    "anchors": """SELECT player, us, balance, versions FROM (
        SELECT *, row_number() OVER (PARTITION BY player ORDER BY CASE WHEN us <= {x0} THEN 0 ELSE 1 END, CASE WHEN us <= {x0} THEN -us ELSE us END) AS k FROM snapshots) s WHERE k = 1 AND versions = 1""",
    "opening": """SELECT a.player, a.balance + coalesce(sum(CASE WHEN t.us >= a.us AND t.us < {x0} THEN t.delta WHEN t.us >= {x0} AND t.us < a.us THEN -t.delta ELSE 0 END), 0) AS balance
        FROM anchors a LEFT JOIN (SELECT player, us, """ + _SIGNED + """ AS delta FROM tx WHERE status = 'SUCCESSFUL' AND us < {x1}) t ON a.player = t.player GROUP BY a.player, a.us, a.balance""",
    "moments": "SELECT player, us, sum(" + _SIGNED + ") AS delta, count_if(type = 'DEPOSIT') AS deposits FROM txw WHERE status = 'SUCCESSFUL' GROUP BY player, us",
    "balances": """SELECT m.player, m.us, m.deposits, round(o.balance + sum(m.delta) OVER (PARTITION BY m.player ORDER BY m.us) - m.delta, 6) AS before,
        round(o.balance + sum(m.delta) OVER (PARTITION BY m.player ORDER BY m.us), 6) AS after FROM moments m JOIN opening o ON m.player = o.player""",
    "drops": """SELECT *, coalesce(sum(fell) OVER (PARTITION BY player ORDER BY us ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS falls_before,
        max(CASE WHEN fell = 1 THEN us END) OVER (PARTITION BY player ORDER BY us ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS fell_us
        FROM (SELECT *, CASE WHEN before >= {least} AND after < {least} THEN 1 ELSE 0 END AS fell FROM balances) b""",
    "refills": """SELECT *, max(CASE WHEN ok THEN us END) OVER (PARTITION BY player ORDER BY us ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ok_us
        FROM (SELECT *, deposits > 0 AND before < {least} AND falls_before > 0 AS ok FROM drops) d""",
    "fallen": """SELECT player, CAST(sum(fell) AS BIGINT) AS falls, CAST(coalesce(sum(CASE WHEN ok THEN deposits END), 0) AS BIGINT) AS refills,
        median(CASE WHEN ok AND (ok_us IS NULL OR ok_us < fell_us) THEN CAST(us - fell_us AS DOUBLE) END) / 1e6 AS seconds FROM refills GROUP BY player""",
    # bet and session groups that a movement belongs to
    "linked": "SELECT player, tx_id, 'bet' AS kind, pk FROM bet_link UNION SELECT player, tx_id, 'ses' AS kind, pk FROM ses_link",
    "link_count": "SELECT player, tx_id, count(*) AS groups, min(kind) AS kind, min(pk) AS pk FROM linked GROUP BY player, tx_id",
    # limits by second: those on participation where a player has any with a span, else all others but game types
    "limit_events": """SELECT player, kind, at, value, CASE WHEN kind <> 'PARTICIPATION' THEN span WHEN span IN ('DAY', 'DAILY') THEN 'DAY' WHEN span IN ('WEEK', 'WEEKLY') THEN 'WEEK' WHEN span IN ('MONTH', 'MONTHLY') THEN 'MONTH' ELSE span END AS span
        FROM (SELECT player, upper(kind) AS kind, CAST(floor(us / 1000000) AS BIGINT) * 1000000 AS at, value, upper(span) AS span FROM lim WHERE value IS NOT NULL) l
        WHERE at >= {x0} AND at < {x1} AND kind <> 'GAME_TYPE' AND (kind <> 'PARTICIPATION' OR span IS NOT NULL)""",
    "limit_line": """SELECT player, at, value, lag(value) OVER (PARTITION BY player, kind, span ORDER BY at, value) AS before
        FROM (SELECT *, max(CASE WHEN kind = 'PARTICIPATION' THEN 1 ELSE 0 END) OVER (PARTITION BY player) AS takes_part FROM limit_events) l
        WHERE takes_part = 0 OR kind = 'PARTICIPATION'""",
    # net stakes by hour bucket: refunds scale the stakes of their group down
    "stake_groups": """SELECT t.player, coalesce(l.kind, 'own') AS kind, coalesce(l.pk, t.tx_id) AS pk,
        sum(CASE WHEN t.type = 'STAKE' THEN abs(t.amount) ELSE 0 END) AS staked,
        sum(CASE WHEN t.type = 'VOID_BET' OR t.type = 'VOID_STAKE' THEN abs(t.amount) ELSE 0 END) AS refunded,
        sum(CASE WHEN t.type = 'STAKE' AND t.us >= {x0} THEN abs(t.amount) ELSE 0 END) AS total,
        sum(CASE WHEN t.type = 'STAKE' AND t.us >= {x0} AND t.hour >= 8 AND t.hour < 16 THEN abs(t.amount) ELSE 0 END) AS morning,
        sum(CASE WHEN t.type = 'STAKE' AND t.us >= {x0} AND t.hour >= 16 THEN abs(t.amount) ELSE 0 END) AS evening,
        max(CASE WHEN l.groups > 1 THEN 1 WHEN l.groups IS NULL AND t.type <> 'STAKE' THEN 1
            WHEN t.type = 'VOID_BET' AND l.kind <> 'bet' THEN 1 WHEN t.type = 'VOID_STAKE' AND l.kind <> 'ses' THEN 1 ELSE 0 END) AS unclear
        FROM tx t LEFT JOIN link_count l ON t.player = l.player AND t.tx_id = l.tx_id
        WHERE t.status = 'SUCCESSFUL' AND t.us < {x1} AND t.type IN ('STAKE', 'VOID_BET', 'VOID_STAKE') GROUP BY 1, 2, 3""",
    "net_stakes": """SELECT player, max(CASE WHEN unclear = 1 OR refunded > staked * 1.00001 + 0.00000001 THEN 1 ELSE 0 END) AS unclear,
        sum(CASE WHEN staked > 0 THEN total * greatest(0, 1 - refunded / staked) ELSE 0 END) AS total,
        sum(CASE WHEN staked > 0 THEN morning * greatest(0, 1 - refunded / staked) ELSE 0 END) AS morning,
        sum(CASE WHEN staked > 0 THEN evening * greatest(0, 1 - refunded / staked) ELSE 0 END) AS evening FROM stake_groups GROUP BY player""",
    "interaction_hours": """SELECT l.player, b.hour FROM betw b JOIN bet_link l ON b.pk = l.pk UNION ALL SELECT l.player, s.hour FROM sesw s JOIN ses_link l ON s.pk = l.pk""",
    # wagers by segment: every successful movement that takes money, stakes whatever their sign; bets, else the type of the session's game
    "segments": """SELECT t.player, CASE WHEN b.tx_id IS NOT NULL THEN 'BET' ELSE coalesce(CASE WHEN s.type IN ('SLOTS', 'CASINO', 'BINGO', 'VIRTUAL_SPORTS') THEN s.type END, 'OTHER') END AS segment,
        sum(abs(t.amount)) AS wager FROM txw t LEFT JOIN (SELECT DISTINCT tx_id FROM bet_link) b ON t.tx_id = b.tx_id
        LEFT JOIN (SELECT l.tx_id, max(g.type) AS type FROM ses_link l JOIN ses x ON l.pk = x.pk JOIN game g ON x.game_id = g.game_id GROUP BY l.tx_id) s ON t.tx_id = s.tx_id
        WHERE t.status = 'SUCCESSFUL' AND (t.amount < 0 OR t.type = 'STAKE' AND t.amount > 0) GROUP BY 1, 2""",
    "shares": "SELECT player, segment, wager / sum(wager) OVER (PARTITION BY player) AS share FROM segments",
    # countries of the clubs that a leg's event names; the club table is a dictionary, read as one list
    "club_list": "SELECT {club_list} AS clubs FROM club WHERE club IS NOT NULL",
    "leg_clubs": "SELECT g.pk, g.sport, upper(g.event) AS event, (SELECT clubs FROM club_list) AS clubs FROM betw b JOIN leg g ON b.pk = g.pk",
    "leg_countries": "SELECT pk, sport, {named_countries} AS countries FROM leg_clubs",
    "bet_legs": "SELECT b.pk, count(g.part_id) AS legs FROM betw b LEFT JOIN leg g ON b.pk = g.pk GROUP BY b.pk",
    "first_bettor": "SELECT pk, min(player) AS player FROM bet_link GROUP BY pk",
    # a bet by operator and id over all its versions: first placement, first report as settled, last known status
    "bet_versions": """SELECT operator, bet_id, min(CASE WHEN us < {x1} THEN us END) AS placed, min(CASE WHEN upper(trim(status)) = 'BET_SETTLED' AND extracted_us < {x1} THEN extracted_us END) AS settled_us,
        CASE WHEN min(CASE WHEN k = 1 AND extracted_us < {x1} THEN upper(trim(status)) END) = max(CASE WHEN k = 1 AND extracted_us < {x1} THEN upper(trim(status)) END) THEN min(CASE WHEN k = 1 AND extracted_us < {x1} THEN upper(trim(status)) END) END AS last_status
        FROM (SELECT *, rank() OVER (PARTITION BY operator, bet_id ORDER BY CASE WHEN extracted_us < {x1} THEN extracted_us END DESC NULLS LAST) AS k FROM bet WHERE bet_id IS NOT NULL) b GROUP BY operator, bet_id""",
    "bet_refs": "SELECT DISTINCT b.operator, b.bet_id, l.player, l.tx_id FROM bet_link l JOIN bet b ON l.pk = b.pk WHERE b.bet_id IS NOT NULL",
    # movements with the bets that they may belong to: several leave all of them unknown
    "bet_moves": """SELECT r.operator, r.bet_id, r.player, t.type, t.us, t.amount, count(*) OVER (PARTITION BY t.player, t.tx_id, t.operator) AS choices
        FROM bet_refs r JOIN tx t ON r.player = t.player AND r.tx_id = t.tx_id AND (t.operator IS NULL OR r.operator IS NULL OR r.operator = t.operator)
        WHERE upper(trim(t.status)) = 'SUCCESSFUL' AND t.type IN ('STAKE', 'WINNING', 'CASH_OUT', 'VOID_BET') AND (t.us IS NULL OR t.us < {x1})""",
    "bet_known": """SELECT m.operator, m.bet_id, m.player, m.type, m.us, m.amount, v.placed, v.settled_us, v.last_status,
        CASE WHEN m.choices > 1 OR m.us IS NULL OR m.us < v.placed THEN 'unknown' WHEN m.type = 'CASH_OUT' THEN 'cashed' WHEN m.amount IS NULL OR m.type = 'WINNING' AND m.amount < 0 THEN 'unknown' WHEN m.amount <> 0 THEN m.type END AS part
        FROM bet_moves m JOIN bet_versions v ON m.operator IS NOT DISTINCT FROM v.operator AND m.bet_id = v.bet_id""",
    "bet_flags": """SELECT operator, bet_id, player, min(placed) AS placed, max(CASE WHEN part = 'STAKE' THEN 1 ELSE 0 END) AS staked, max(CASE WHEN part IN ('unknown', 'cashed', 'WINNING') THEN 1 ELSE 0 END) AS no_loss,
        min(CASE WHEN part = 'VOID_BET' THEN us END) AS void_us, min(CASE WHEN last_status = 'BET_SETTLED' THEN settled_us END) AS settled_us FROM bet_known GROUP BY operator, bet_id, player""",
    "losses": """SELECT operator, player, closed FROM (SELECT *, coalesce(void_us, settled_us) AS closed FROM bet_flags WHERE staked = 1 AND no_loss = 0) f WHERE closed >= placed AND closed >= {x0}""",
    "bet_line": """SELECT operator, player, closed AS us, 1 AS kind FROM losses UNION ALL SELECT operator, player, placed AS us, 0 AS kind FROM bet_flags WHERE staked = 1 AND placed >= {x0}""",
    # read backwards in time the frame grows by a row at a time
    "next_bets": """SELECT player, kind, us, min(CASE WHEN kind = 0 THEN us END) OVER (PARTITION BY operator, player ORDER BY -us RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS next_us FROM bet_line""",
    "big_wins": """SELECT player, us, tx_id FROM (SELECT player, us, tx_id, row_number() OVER (PARTITION BY player ORDER BY abs(amount) DESC, us, tx_id) AS k FROM txw WHERE type = 'WINNING' AND status = 'SUCCESSFUL') w WHERE k = 1""",
    "around_win": """SELECT s.player, s.stake, CASE WHEN s.us <= w.us THEN 0 ELSE 1 END AS later,
        row_number() OVER (PARTITION BY s.player, CASE WHEN s.us <= w.us THEN 0 ELSE 1 END ORDER BY CASE WHEN s.us <= w.us THEN -s.us ELSE s.us END, CASE WHEN s.us <= w.us THEN -s.tx_id ELSE s.tx_id END) AS k
        FROM stake_line s JOIN big_wins w ON s.player = w.player""",
    "gaps": """SELECT player, dayno, (us - before) / 3600000000.0 AS gap FROM (SELECT player, dayno, us, lag(us) OVER (PARTITION BY player, dayno ORDER BY us) AS before FROM txw) g WHERE us > before AND us - before < 86400000000""",
    "fences": "SELECT player, {q25} AS q1, {q75} AS q3 FROM gaps GROUP BY player",
    "streak_ends": "SELECT player, last_day, row_number() OVER (PARTITION BY player ORDER BY last_day DESC) AS from_last FROM islands",
    "gap_days": "SELECT DISTINCT player, dayno FROM gaps",
    # ends of streaks that a later day with gaps confirms before the next end replaces them, and the last day
    "boundary": """SELECT e.player, e.last_day AS dayno FROM streak_ends e WHERE e.from_last = 1
        UNION SELECT p.player, p.last_day AS dayno FROM (SELECT g.player, g.dayno, max(e.last_day) AS last_day FROM gap_days g JOIN streak_ends e ON g.player = e.player AND e.last_day < g.dayno GROUP BY g.player, g.dayno) p""",
    "status_line": """SELECT player, modified_us, CASE WHEN min(status) = max(status) THEN min(status) END AS status FROM (
        SELECT player, modified_us, status, rank() OVER (PARTITION BY player, modified_us ORDER BY extracted_us DESC) AS k FROM prof WHERE modified_us < {x1_incl} AND extracted_us < {x1_incl}) p WHERE k = 1 GROUP BY player, modified_us""",
    "status_steps": "SELECT player, status, lag(status) OVER (PARTITION BY player ORDER BY modified_us) AS before FROM status_line",
    "day_sums": "SELECT player, dayno, count(*) AS n, sum(CASE WHEN type = 'STAKE' AND status = 'SUCCESSFUL' THEN abs(amount) END) AS stake, sum(amount) AS total FROM txw GROUP BY player, dayno",
    "week_days": "SELECT player, floor((dayno + 3) / 7) AS week, count(*) AS n FROM days GROUP BY 1, 2",
    "deposit_days": "SELECT player, dayno, sum(CASE WHEN type = 'DEPOSIT' AND status = 'SUCCESSFUL' AND amount > 0 THEN 1 ELSE 0 END) AS deposits, sum(amount) AS amount FROM tx GROUP BY player, dayno",
    "last_days": "SELECT player, max(dayno) AS last_day FROM deposit_days GROUP BY player",
}


def _count_per_day(name: str, column: str, where: str) -> str:
    return f"""SELECT coalesce(c.player, f.player) AS player, {_r("CASE WHEN coalesce(f.f1_active_days, 0) = 0 THEN CASE WHEN coalesce(c.n, 0) = 0 THEN 0 END ELSE coalesce(c.n, 0) / f.f1_active_days END")} AS {column}
        FROM (SELECT player, count(*) AS n FROM txw WHERE {where} GROUP BY player) c FULL OUTER JOIN f1 f ON c.player = f.player"""


def _segment(name: str, segment: str) -> str:
    return f"SELECT f.player, CAST(coalesce(max(CASE WHEN s.segment = '{segment}' AND s.share >= 0.7 THEN 1 ELSE 0 END), 0) AS BIGINT) AS {name} FROM f1 f LEFT JOIN shares s ON f.player = s.player GROUP BY f.player"


def _fixed_window(name: str, prefix: str, bounds: tuple[int, int] | None) -> str:
    """Deposits, active days and exclusions of a window; with the feature window all players, without data unknown."""
    lo, hi = bounds or ("{x0}", "{x1}")
    dep, wd = f"type = 'DEPOSIT' AND amount IS NOT NULL", f"type = 'WITHDRAWAL' AND amount IS NOT NULL"
    moves = f"""SELECT player, count_if({dep}) AS deposits, count(DISTINCT dayno) AS days, var_samp(CASE WHEN {dep} THEN abs(amount) END) AS spread,
        sum(CASE WHEN {wd} THEN abs(amount) WHEN {dep} THEN -abs(amount) ELSE 0 END) AS net FROM tx WHERE us >= {lo} AND us < {hi} AND lower(status) = 'successful' GROUP BY player"""
    seen = f"SELECT player, count_if(status = 'SELF_EXCLUDED_TEMP') AS exclusions FROM prof WHERE modified_us >= {lo} AND modified_us < {hi} GROUP BY player"
    known = "w.player IS NOT NULL"
    columns = {
        "deposits": "CAST(coalesce(w.deposits, 0) AS BIGINT)",
        "active_days": "CAST(coalesce(w.days, 0) AS BIGINT)",
        "active_days_per_deposit": _r("CASE WHEN w.deposits > 0 THEN w.days / CAST(w.deposits AS DOUBLE) ELSE 0 END"),
        "temp_exclusions": "CAST(coalesce(w.exclusions, 0) AS BIGINT)",
        "deposit_variance": _r("coalesce(w.spread, 0)"),
        "withdrawn_less_deposited": _r("coalesce(w.net, 0)"),
    }
    picks = ", ".join(f"CASE WHEN {known} THEN {v} END AS {prefix}_{k}" for k, v in columns.items())
    everyone = "SELECT player FROM tx UNION SELECT player FROM prof"
    inside = f"(SELECT coalesce(m.player, q.player) AS player, m.deposits, m.days, m.spread, m.net, q.exclusions FROM ({moves}) m FULL OUTER JOIN ({seen}) q ON m.player = q.player)"
    return f"SELECT e.player, {picks} FROM ({everyone}) e {'JOIN' if bounds else 'LEFT JOIN'} {inside} w ON e.player = w.player"


def _bitmaps() -> str:
    """Months with an exclusion, where a run of them starts and ends, and months with an uncertain status; one row per player with a profile in them."""
    edges = month_edges()
    flags = [f"max(CASE WHEN modified_us >= {lo} AND modified_us < {hi} AND status IN {_in(which)} THEN 1 ELSE 0 END) AS {letter}{i}" for letter, which in (("o", EXCLUDED), ("u", UNCERTAIN)) for i, (_, lo, hi) in enumerate(edges)]
    picks = []
    for i, (name, _, _) in enumerate(edges):
        starts = f"o{i}" if i == 0 else f"o{i} * (1 - o{i - 1})"
        ends = f"o{i}" if i == len(edges) - 1 else f"o{i} * (1 - o{i + 1})"
        picks += [f"CAST({x} AS BIGINT) AS y_2{letter}_{name}_{what}" for letter, what, x in (("a", "observed", f"o{i}"), ("b", "start", starts), ("c", "end", ends), ("d", "uncertain", f"u{i}"))]
    return f"SELECT player, {', '.join(picks)} FROM (SELECT player, {', '.join(flags)} FROM prof WHERE modified_us >= {edges[0][1]} AND modified_us < {edges[-1][2]} GROUP BY player) m"


FEATURES: dict[str, str] = {
    "f0": f"SELECT player, {_r('sum(amount)')} AS f0_net_winloss FROM txw WHERE {_OK} AND type IN {_NET} GROUP BY player",
    "f1": "SELECT player, count(DISTINCT dayno) AS f1_active_days FROM txw WHERE type = 'STAKE' GROUP BY player",
    "f2": f"SELECT a.player, {_r('CASE WHEN b.f1_active_days > 0 THEN a.f0_net_winloss / b.f1_active_days END')} AS f2_net_loss_per_day FROM f0 a JOIN f1 b ON a.player = b.player",
    "f3": f"SELECT player, {_r('''sum(CASE WHEN type = 'STAKE' THEN -abs(amount) ELSE abs(amount) END)''')} AS f3_total_wagered FROM txw WHERE {_OK} AND type IN ('STAKE', 'VOID_BET', 'VOID_STAKE') GROUP BY player",
    "f4": f"SELECT a.player, {_r('CASE WHEN b.f1_active_days > 0 THEN (CASE WHEN a.f3_total_wagered > 0 THEN -abs(a.f3_total_wagered) ELSE a.f3_total_wagered END) / b.f1_active_days END')} AS f4_average_wager_per_day FROM f3 a LEFT JOIN f1 b ON a.player = b.player",
    "f6": """SELECT player, CAST(floor(({ref_day} - dob) / 10000) AS BIGINT) AS f6_age FROM (SELECT player, dob, row_number() OVER (PARTITION BY player ORDER BY coalesce(modified_us, extracted_us) DESC, pk) AS k FROM prof) p
        WHERE k = 1 AND floor(({ref_day} - dob) / 10000) BETWEEN 18 AND 120""",
    "f7": f"""SELECT a.player, {_r('CASE WHEN a.f3_total_wagered <> 0 THEN abs(0.95 - coalesce(w.won, 0) / abs(a.f3_total_wagered)) END')} AS f7_rtp_deviation
        FROM f3 a LEFT JOIN (SELECT player, sum(abs(amount)) AS won FROM txw WHERE {_OK} AND type = 'WINNING' GROUP BY player) w ON a.player = w.player""",
    "f8": f"""SELECT i.player, {_r('CASE WHEN f.f1_active_days > 0 THEN i.n / f.f1_active_days END')} AS f8_interactions_per_day FROM (
        SELECT player, count(*) AS n FROM (SELECT p.player, 'bet' AS kind, b.bet_id AS id FROM betw b JOIN bet_player p ON b.pk = p.pk WHERE b.status IN ('BET_PLACED', 'BET_UPDATED', 'BET_SETTLED')
        UNION SELECT p.player, 'ses' AS kind, s.session_id AS id FROM sesw s JOIN ses_player p ON s.pk = p.pk) u GROUP BY player) i LEFT JOIN f1 f ON i.player = f.player""",
    "f9": f"""SELECT coalesce(w.player, f.player) AS player, {_r("CASE WHEN coalesce(f.f1_active_days, 0) = 0 THEN CASE WHEN coalesce(w.n, 0) = 0 THEN 0 END ELSE coalesce(w.n, 0) / f.f1_active_days END")} AS f9_big_wins_per_day FROM (
        SELECT player, count(*) AS n FROM (SELECT l.player, l.kind, l.pk, sum(CASE WHEN t.type = 'STAKE' THEN abs(t.amount) ELSE 0 END) AS staked, sum(CASE WHEN t.type = 'WINNING' THEN t.amount ELSE 0 END) AS won
        FROM linked l JOIN (SELECT pk, 'bet' AS kind FROM betw UNION ALL SELECT pk, 'ses' AS kind FROM sesw) h ON l.pk = h.pk AND l.kind = h.kind JOIN txw t ON l.tx_id = t.tx_id WHERE t.{_OK} GROUP BY 1, 2, 3) g
        WHERE staked > 0 AND won > staked GROUP BY player) w FULL OUTER JOIN f1 f ON w.player = f.player""",
    "f10": f"""SELECT f.player, {_r('CASE WHEN f.f1_active_days > 0 THEN coalesce(c.n, 0) / f.f1_active_days END')} AS f10_canceled_withdrawals_per_day
        FROM f1 f LEFT JOIN (SELECT player, count(*) AS n FROM txw WHERE type = 'WITHDRAWAL' AND status = 'UNSUCCESSFUL' GROUP BY player) c ON f.player = c.player""",
    "f11": _count_per_day("f11", "f11_withdrawals_per_day", f"type = 'WITHDRAWAL' AND {_OK}"),
    "f12": _count_per_day("f12", "f12_deposits_per_day", f"type = 'DEPOSIT' AND {_OK}"),
    "f13": _count_per_day("f13", "f13_canceled_deposits_per_day", "type = 'DEPOSIT' AND status = 'UNSUCCESSFUL'"),
    "f14": "SELECT player, CAST(max(dayno) - min(dayno) + 1 AS BIGINT) AS f14_active_period_span FROM txw GROUP BY player",
    "f15": f"SELECT a.player, {_r('CASE WHEN b.f14_active_period_span > 0 THEN CAST(a.f1_active_days AS DOUBLE) / b.f14_active_period_span END')} AS f15_active_day_fraction FROM f1 a JOIN f14 b ON a.player = b.player",
    "f16": f"""SELECT player, CAST(greatest(1, max(CASE WHEN us >= {{x0}} THEN dayno END) - min(dayno)) AS BIGINT) AS f16_account_age FROM tx
        WHERE {_OK} AND upper(trim(type)) IN ('STAKE', 'DEPOSIT', 'WITHDRAWAL') AND us < {{x1_incl}} GROUP BY player HAVING max(CASE WHEN us >= {{x0}} THEN dayno END) IS NOT NULL""",
    "f17": """SELECT player, nullif(count(DISTINCT country), 0) AS f17_number_of_bet_countries FROM (SELECT p.player, {each_country} AS country FROM leg_countries c JOIN bet_player p ON c.pk = p.pk) c GROUP BY player""",
    "f18": "SELECT p.player, nullif(count(DISTINCT nullif(trim(g.sport), '')), 0) AS f18_number_of_bet_sports FROM betw b JOIN bet_player p ON b.pk = p.pk JOIN leg g ON b.pk = g.pk GROUP BY p.player",
    "f19": "SELECT p.player, nullif(max(l.legs), 0) AS f19_max_bet_parts FROM bet_legs l JOIN bet_player p ON l.pk = p.pk GROUP BY p.player",
    "f20": f"""SELECT l.player, {_r('sum(d.home) / CAST(count(*) AS DOUBLE)')} AS f20_domestic_bets_pct FROM (SELECT pk, max(CASE WHEN {{at_home}} THEN 1 ELSE 0 END) AS home
        FROM leg_countries WHERE upper(sport) IN {_in(FOOTBALL)} GROUP BY pk) d JOIN bet_link l ON d.pk = l.pk GROUP BY l.player""",
    "f22": "SELECT player, count(DISTINCT CASE WHEN value > before THEN at END) AS f22_limit_increases FROM limit_line GROUP BY player",
    "f23": "SELECT player, count(DISTINCT CASE WHEN value < before THEN at END) AS f23_limit_decreases FROM limit_line GROUP BY player",
    "f24": "SELECT player, count(DISTINCT instrument) AS f24_payment_method_variety FROM txw WHERE type IN ('DEPOSIT', 'WITHDRAWAL') GROUP BY player",
    "f25": """SELECT player, CASE WHEN max(CASE WHEN status IS NULL THEN 1 ELSE 0 END) = 1 THEN NULL
        ELSE count_if(status IN ('SELF_EXCLUDED_TEMP', 'SELF_EXCLUDED_INDEF') AND (before IS NULL OR before NOT IN ('SELF_EXCLUDED_TEMP', 'SELF_EXCLUDED_INDEF'))) END AS f25_voluntary_suspensions FROM status_steps GROUP BY player""",
    "f26": f"SELECT f.player, {_r('b.falls / CAST(f.f1_active_days AS DOUBLE)')} AS f26_balance_drop_frequency FROM f1 f LEFT JOIN fallen b ON f.player = b.player",
    "f27": f"SELECT f.player, {_r('CASE WHEN b.falls > 0 THEN b.refills / CAST(f.f1_active_days AS DOUBLE) END')} AS f27_deposits_after_low_per_day FROM f1 f LEFT JOIN fallen b ON f.player = b.player",
    "f28": f"SELECT player, seconds AS f28_median_seconds_low_to_deposit FROM fallen",
    "f29": f"""SELECT f.player, {_r('nullif(s.n, 0) / CAST(f.f1_active_days AS DOUBLE)')} AS f29_sessions_per_day FROM f1 f LEFT JOIN (
        SELECT p.player, count(DISTINCT s.session_id) AS n FROM sesw s JOIN ses_player p ON s.pk = p.pk GROUP BY p.player) s ON f.player = s.player""",
    "f30": f"SELECT l.player, {_r('count(*) / CAST(count(DISTINCT s.session_id) AS DOUBLE)')} AS f30_avg_interactions_per_session FROM sesw s JOIN ses_link l ON s.pk = l.pk GROUP BY l.player",
    "f31": f"SELECT p.player, {_r('median(CASE WHEN s.rounds > 0 THEN CAST(s.rounds AS DOUBLE) END)')} AS f31_median_rounds_per_session FROM sesw s JOIN ses_player p ON s.pk = p.pk GROUP BY p.player",
    "f32": """SELECT f.player, coalesce(s.n, 0) AS f32_game_types_count FROM f1 f LEFT JOIN (SELECT p.player, count(DISTINCT coalesce(g.type, CAST(s.game_id AS STRING))) AS n
        FROM sesw s JOIN ses_player p ON s.pk = p.pk LEFT JOIN game g ON s.game_id = g.game_id GROUP BY p.player) s ON f.player = s.player""",
    "f33": _segment("f33_70_bets", "BET"),
    "f34": _segment("f34_70_slots", "SLOTS"),
    "f35": _segment("f35_70_casino", "CASINO"),
    "f36": _segment("f36_70_bingo", "BINGO"),
    "f37": _segment("f37_70_virtual_sports", "VIRTUAL_SPORTS"),
    "f38": _segment("f38_70_other", "OTHER"),
    "f39": f"""SELECT coalesce(b.player, s.player) AS player, {_r('greatest(coalesce(b.v, 0), coalesce(s.v, 0)) / nullif(coalesce(b.v, 0) + coalesce(s.v, 0), 0)')} AS f39_dominant_segment_share
        FROM (SELECT p.player, sum(b.stake) AS v FROM betw b JOIN first_bettor p ON b.pk = p.pk WHERE b.stake > 0 GROUP BY p.player) b
        FULL OUTER JOIN (SELECT l.player, CAST(count(*) AS DOUBLE) AS v FROM sesw s JOIN ses_link l ON s.pk = l.pk GROUP BY l.player) s ON b.player = s.player""",
    "f40": f"""SELECT f.player, {_r('nullif(s.n, 0) / CAST(f.f1_active_days AS DOUBLE)')} AS f40_products_per_active_day FROM f1 f LEFT JOIN (
        SELECT p.player, count(DISTINCT g.name) AS n FROM sesw s JOIN ses_player p ON s.pk = p.pk JOIN game g ON s.game_id = g.game_id GROUP BY p.player) s ON f.player = s.player""",
    "f41": """SELECT player, count_if(n >= total / 48.0) AS f41_heavy_play_hours_count FROM (SELECT player, hour, n, sum(n) OVER (PARTITION BY player) AS total FROM (
        SELECT t.player, t.hour, count(*) AS n FROM txw t WHERE t.status = 'SUCCESSFUL' AND t.tx_id IN (SELECT l.tx_id FROM betw b JOIN bet_link l ON b.pk = l.pk UNION SELECT l.tx_id FROM sesw s JOIN ses_link l ON s.pk = l.pk)
        GROUP BY t.player, t.hour) h) w GROUP BY player""",
    "f42": f"SELECT player, {_r('avg(CASE WHEN hour >= 8 AND hour < 16 THEN 1e0 ELSE 0e0 END)')} AS f42_morning_interaction_percentage FROM interaction_hours GROUP BY player",
    "f43": f"SELECT player, {_r('avg(CASE WHEN hour >= 16 THEN 1e0 ELSE 0e0 END)')} AS f43_evening_interaction_percentage FROM interaction_hours GROUP BY player",
    "f44": f"SELECT player, {_r('CASE WHEN unclear = 0 AND total > 0 THEN morning / total END')} AS f44_morning_stakes_percentage FROM net_stakes",
    "f45": f"SELECT player, {_r('CASE WHEN unclear = 0 AND total > 0 THEN evening / total END')} AS f45_evening_stakes_percentage FROM net_stakes",
    "f46": f"""SELECT p.player, median(CASE WHEN b.extracted_us > b.us THEN CAST(b.extracted_us - b.us AS DOUBLE) END) / 1e6 AS f46_median_seconds_bet_placed_to_resolved
        FROM betw b JOIN bet_player p ON b.pk = p.pk WHERE upper(trim(b.status)) IN ('BET_SETTLED', 'BET_CANCELLED') GROUP BY p.player""",
    "f47": f"SELECT p.player, median(CAST({{x1}} - s.us AS DOUBLE)) / 1e6 AS f47_median_seconds_session_start_to_period_end FROM sesw s JOIN ses_player p ON s.pk = p.pk GROUP BY p.player",
    "f48": f"""SELECT player, {_r('sum(cashed) / CAST(count(*) AS DOUBLE)')} AS f48_percentage_bets_with_cashout FROM (
        SELECT l.player, b.bet_id, max(CASE WHEN b.status = 'BET_CANCELLED' THEN 1 ELSE 0 END) AS cancelled, max(CASE WHEN t.type = 'VOID_BET' THEN 1 ELSE 0 END) AS voided, max(CASE WHEN t.type = 'CASH_OUT' THEN 1 ELSE 0 END) AS cashed
        FROM betw b JOIN bet_link l ON b.pk = l.pk LEFT JOIN tx t ON l.tx_id = t.tx_id AND l.player = t.player AND t.status = 'SUCCESSFUL' GROUP BY l.player, b.bet_id) e WHERE cancelled = 0 AND voided = 0 GROUP BY player""",
    "f49": f"""SELECT p.player, {_r('avg(CASE WHEN g.live = 1 THEN 1e0 ELSE 0e0 END)')} AS f49_percentage_live_bets FROM betw b JOIN bet_player p ON b.pk = p.pk
        LEFT JOIN (SELECT pk, max(CASE WHEN lower(trim(live)) IN ('true', '1', 'yes', 'ja') THEN 1 ELSE 0 END) AS live FROM leg GROUP BY pk) g ON b.pk = g.pk GROUP BY p.player""",
    "f50": f"SELECT p.player, {_r('avg(CASE WHEN l.legs = 1 THEN 1e0 ELSE 0e0 END)')} AS f50_single_bet_percentage FROM bet_legs l JOIN first_bettor p ON l.pk = p.pk GROUP BY p.player",
    "f51": f"""SELECT p.player, median(CAST(n.next_us - n.us AS DOUBLE)) / 1e6 AS f51_median_seconds_loss_to_next_bet FROM (SELECT DISTINCT player FROM bet_link WHERE player IS NOT NULL) p
        LEFT JOIN (SELECT * FROM next_bets WHERE kind = 1 AND next_us IS NOT NULL) n ON p.player = n.player GROUP BY p.player""",
    "f52": """SELECT player, CASE WHEN count_if(later = 0) >= 5 AND count_if(later = 1) >= 5 AND avg(CASE WHEN later = 1 THEN stake END) >= 2 * avg(CASE WHEN later = 0 THEN stake END) THEN 1e0 ELSE 0e0 END AS f52_big_win_wager_increase_count
        FROM around_win WHERE k <= 10 GROUP BY player""",
    "f53": f"SELECT player, {_r('abs(sum(CASE WHEN half = 2 THEN stake ELSE -stake END)) / count(*)')} AS f53_abs_gradient_wagered_around_median_date FROM stake_line GROUP BY player",
    "f54": f"""SELECT player, {_r('count(DISTINCT CASE WHEN half = 2 THEN dayno END) / CAST(count(DISTINCT CASE WHEN half = 1 THEN dayno END) + count(DISTINCT CASE WHEN half = 2 THEN dayno END) AS DOUBLE)')} AS f54_post_median_active_days_percentage FROM stake_line GROUP BY player""",
    "f55": f"SELECT player, {_r('abs(var_samp(CASE WHEN half = 2 THEN stake END) - var_samp(CASE WHEN half = 1 THEN stake END))')} AS f55_stake_variance_difference FROM stake_line GROUP BY player",
    "f56": f"""SELECT player, {_r('abs(stddev_samp(CASE WHEN half = 2 THEN stake END) / nullif(avg(CASE WHEN half = 2 THEN stake END), 0) - stddev_samp(CASE WHEN half = 1 THEN stake END) / nullif(avg(CASE WHEN half = 1 THEN stake END), 0))')} AS f56_stake_cv_difference FROM stake_line GROUP BY player""",
    "f57": "SELECT player, max(n) AS f57_longest_daily_streak FROM islands GROUP BY player",
    "f58": f"SELECT player, {_r('max(n) / CAST(sum(n) AS DOUBLE)')} AS f58_longest_streak_ratio FROM islands GROUP BY player",
    "f59": f"""SELECT g.player, {_r('median(g.gap)')} AS f59_median_daily_time_off FROM gaps g JOIN fences q ON g.player = q.player LEFT JOIN boundary b ON g.player = b.player AND g.dayno = b.dayno
        WHERE b.player IS NULL OR g.gap BETWEEN q.q1 - 1.5 * (q.q3 - q.q1) AND q.q3 + 1.5 * (q.q3 - q.q1) GROUP BY g.player""",
    "f60": f"SELECT player, {_r('CASE WHEN count(*) >= 2 THEN stddev_samp(amount) / avg(amount) END')} AS f60_deposit_amount_variability FROM txw WHERE type = 'DEPOSIT' AND {_OK} AND amount > 0 GROUP BY player",
    "f61": f"SELECT p.player, {_r('CASE WHEN count(*) >= 2 THEN stddev_samp(g.odds) / avg(g.odds) END')} AS f61_bet_odds_variability FROM betw b JOIN first_bettor p ON b.pk = p.pk JOIN leg g ON b.pk = g.pk WHERE g.odds > 0 GROUP BY p.player",
    # the basic set
    "var1a": f"SELECT player, {_r('sum(abs(amount))')} AS var1a_total_stake FROM txw WHERE type = 'STAKE' AND {_OK} GROUP BY player",
    "var1b": f"SELECT player, {_r('var_pop(stake)')} AS var1b_stake_day_variance FROM day_sums WHERE stake IS NOT NULL GROUP BY player",
    "var1c": f"SELECT player, {_r('sum(amount)')} AS var1c_total_won FROM txw WHERE type = 'WINNING' AND {_OK} GROUP BY player",
    "var2a": "SELECT player, count(*) AS var2a_transactions FROM txw GROUP BY player",
    "var2b": f"SELECT player, {_r('var_pop(CAST(n AS DOUBLE))')} AS var2b_transactions_day_variance FROM day_sums GROUP BY player",
    "var3a": "SELECT player, count(*) AS var3a_active_days FROM days GROUP BY player",
    "var3b": f"SELECT player, {_r('var_pop(CAST(n AS DOUBLE))')} AS var3b_active_days_week_variance FROM week_days GROUP BY player",
    "var3c": f"SELECT player, {_r('count(*) / CAST({n_days} AS DOUBLE)')} AS var3c_active_day_share FROM days GROUP BY player",
    "var4": f"""SELECT player, count_if(type = 'DEPOSIT') AS var4a_deposits, count_if(type = 'WITHDRAWAL') AS var4b_withdrawals, count_if(type = 'STAKE') AS var4c_stakes, count_if(type = 'WINNING') AS var4d_winnings,
        count_if(type = 'OTHER') AS var4e_other, count_if(type = 'BONUS') AS var4f_bonus FROM txw WHERE {_OK} GROUP BY player""",
    "var5": """SELECT player, count(DISTINCT nullif(upper(trim(instrument)), '')) AS var5a_instruments, count_if(upper(trim(instrument)) = 'CREDIT_CARD') AS var5b_credit_card, count_if(upper(trim(instrument)) = 'ELECTRONIC_MONEY') AS var5c_electronic_money,
        count_if(upper(trim(instrument)) = 'BANK_TRANSFER') AS var5d_bank_transfer, count_if(upper(trim(instrument)) NOT IN ('CREDIT_CARD', 'ELECTRONIC_MONEY', 'BANK_TRANSFER', '')) AS var5e_other FROM txw GROUP BY player""",
    "var6": "SELECT player, count_if(n >= 5) AS var6a_days_5, count_if(n >= 25) AS var6b_days_25, count_if(n >= 100) AS var6c_days_100 FROM day_sums GROUP BY player",
    "var7": "SELECT player, count(*) AS var7a_limits, count_if(kind = 'DEPOSIT') AS var7b_deposit, count_if(kind = 'LOGIN') AS var7c_login, count_if(kind = 'BALANCE') AS var7d_balance FROM lim WHERE us >= {x0} AND us < {x1} GROUP BY player",
    "var8a": "SELECT player, dob AS var8a_birth_day FROM (SELECT player, dob, row_number() OVER (PARTITION BY player ORDER BY coalesce(modified_us, extracted_us) DESC, pk) AS k FROM prof) p WHERE k = 1",
    "var9a": "SELECT player, count(DISTINCT account) AS var9a_bank_accounts FROM account GROUP BY player",
    "var10": "SELECT player, "
    + ", ".join(f"CAST(max(CASE WHEN upper(trim(status)) = '{x}' THEN 1 ELSE 0 END) AS BIGINT) AS var10{k}_{x.lower()}" for k, x in zip("abcdefgh", STATUSES, strict=True))
    + " FROM prof WHERE status IS NOT NULL AND (modified_us IS NULL OR (modified_us >= {x0} AND modified_us < {x1})) GROUP BY player",
    "var10i": f"SELECT player, {_r('avg(eod_balance)')} AS var10i_mean_balance FROM prof WHERE extracted_us >= {{x0}} AND extracted_us < {{x1}} GROUP BY player",
    "var10kl": f"SELECT player, count_if(upper(status) = 'UNSUCCESSFUL') AS var10k_unsuccessful, {_r('''count_if(upper(status) = 'SUCCESSFUL') / CAST(count(*) AS DOUBLE)''')} AS var10l_success_ratio FROM txw GROUP BY player",
    "var11": "SELECT player, count(complaint_id) AS var11_complaints FROM complaint WHERE us >= {x0} AND us < {x1} GROUP BY player",
    "var12": "SELECT player, count(*) AS var12_interventions FROM contact WHERE us >= {x0} AND us < {x1} GROUP BY player",
    "var13": """SELECT p.player, count(DISTINCT coalesce(nullif(trim(g.type), ''), CAST(s.game_id AS STRING))) AS var13_game_types FROM sesw s JOIN ses_player p ON s.pk = p.pk LEFT JOIN game g ON s.game_id = g.game_id GROUP BY p.player""",
    "var14": f"""SELECT p.player, count(*) AS var14a_sessions, CAST(coalesce(sum(s.rounds), 0) AS BIGINT) AS var14b_rounds, {_r('avg(CASE WHEN s.end_us >= s.us THEN (s.end_us - s.us) / 1000000.0 END)')} AS var14c_mean_session_seconds,
        {_r('coalesce(sum(CASE WHEN s.end_us >= s.us THEN (s.end_us - s.us) / 1000000.0 END), 0)')} AS var14d_session_seconds FROM sesw s JOIN ses_player p ON s.pk = p.pk GROUP BY p.player""",
    "var15": "SELECT p.player, count(*) AS var15a_bets, count_if(l.legs > 1) AS var15b_combined_bets FROM bet_legs l JOIN first_bettor p ON l.pk = p.pk GROUP BY p.player",
    "var16": "SELECT c.player, CAST(sum(coalesce(r.n, 0)) AS BIGINT) AS var16_responses FROM complaint c LEFT JOIN (SELECT row_id, count(*) AS n FROM response GROUP BY row_id) r ON c.row_id = r.row_id WHERE c.us >= {x0} AND c.us < {x1} GROUP BY c.player",
    "var17": "SELECT player, count_if(status = 'SELF_EXCLUDED_TEMP') AS var17_temp_exclusions FROM prof WHERE extracted_us >= {x0} AND extracted_us < {x1} GROUP BY player",
    "var18": "SELECT player, count(DISTINCT floor(extracted_us / 86400000000)) AS var18_extraction_days FROM prof WHERE extracted_us >= {x0} AND extracted_us < {x1} GROUP BY player",
    "var19": "SELECT player, count_if(dow >= 5) AS var19a_weekend, count_if(hour >= 22 OR hour < 6) AS var19b_night FROM txw GROUP BY player",
    "var20": f"SELECT player, max(n) AS var20a_max_day_transactions, {_r('max(total)')} AS var20b_max_day_amount FROM day_sums GROUP BY player",
    # legacy set and targets
    "transaction_amount_sum": f"SELECT player, {_r('sum(coalesce(amount, 0))')} AS transaction_amount_sum FROM tx GROUP BY player",
    "transaction_amount_sum_in_games": f"SELECT l.player, {_r('sum(coalesce(t.amount, 0))')} AS transaction_amount_sum_in_games FROM ses_link l JOIN tx t ON l.tx_id = t.tx_id GROUP BY l.player",
    "latest_limits": """SELECT player, kind, value, span FROM (SELECT *, row_number() OVER (PARTITION BY player, kind ORDER BY us DESC, value{nulls_last}, span{nulls_last}) AS k FROM lim) l WHERE k = 1""",
    "avg_nr_of_game_transactions": f"SELECT player, {_r('avg(CAST(n AS DOUBLE))')} AS avg_nr_of_game_transactions FROM (SELECT player, pk, count(*) AS n FROM ses_link GROUP BY player, pk) s GROUP BY player",
    "avg_nr_of_bet_parts_per_bet": f"SELECT p.player, {_r('avg(CAST(l.legs AS DOUBLE))')} AS avg_nr_of_bet_parts_per_bet FROM (SELECT b.pk, count(g.part_id) AS legs FROM bet b LEFT JOIN leg g ON b.pk = g.pk GROUP BY b.pk) l JOIN first_bettor p ON l.pk = p.pk GROUP BY p.player",
    "transactions": "SELECT d.player, CAST(sum(d.deposits) AS BIGINT) AS x_1_a, count(*) AS x_1_b, "
    + ", ".join(
        f"{_r(f'sum(CASE WHEN d.dayno >= m.last_day - {n} THEN d.deposits ELSE 0 END) / {n}.0')} AS x_1_c_{n}, {_r(f'sum(CASE WHEN d.dayno >= m.last_day - {n} THEN d.amount ELSE 0 END) / {n}.0')} AS x_1_d_{n}"
        for n in (30, 60, 300, 600)
    )
    + " FROM deposit_days d JOIN last_days m ON d.player = m.player GROUP BY d.player",
    **{name: _fixed_window(name, prefix, bounds) for name, prefix, bounds in (("flexible_x", "x", None), ("april_may", "x_am", (day_number(2025, 4) * DAY_US, day_number(2025, 6) * DAY_US)))},
    "self_exclusion_y": """SELECT player, CASE WHEN count(CASE WHEN modified_us >= {y0} AND modified_us < {y1} THEN 1 END) = 0 THEN NULL
        ELSE CAST(max(CASE WHEN modified_us >= {y0} AND modified_us < {y1} AND status LIKE 'SELF_EXCLUDED%' THEN 1 ELSE 0 END) AS BIGINT) END AS y_self_exclusion FROM prof GROUP BY player""",
    "june_july": f"SELECT player, CAST(max(CASE WHEN status IN {_in(EXCLUDED)} THEN 1 ELSE 0 END) AS BIGINT) AS y_self_exclusion_june_july FROM prof WHERE modified_us >= {day_number(2025, 6) * DAY_US} AND modified_us < {day_number(2025, 8) * DAY_US} GROUP BY player",
    # the status counts at the first profile of each extraction time; an exclusion counts while it is the last or the last but one
    "ever_excluded": f"""SELECT player, CAST(y AS BIGINT) AS y_1b_ever_excluded, status AS y_1c_last_status, extracted_us AS y_1d_extracted_us, n AS y_1x_profiles,
        CAST(CASE WHEN status IN {_in((*EXCLUDED, 'ACTIVE'))} THEN 1 ELSE 0 END AS BIGINT) AS y_1e_certain, CAST(CASE WHEN status IN {_in((*EXCLUDED, 'ACTIVE'))} THEN y END AS BIGINT) AS y_1_final
        FROM (SELECT *, CASE WHEN status IN {_in(EXCLUDED)} OR lag(status) OVER (PARTITION BY player ORDER BY extracted_us) IN {_in(EXCLUDED)} THEN 1 ELSE 0 END AS y, row_number() OVER (PARTITION BY player ORDER BY extracted_us DESC) AS from_last
        FROM (SELECT *, row_number() OVER (PARTITION BY player, extracted_us ORDER BY pk) AS k, count(*) OVER (PARTITION BY player) AS n FROM prof WHERE extracted_us IS NOT NULL) p WHERE k = 1) q WHERE from_last = 1""",
    "monthly_exclusion": _bitmaps(),
    "time_eas": "SELECT DISTINCT player, 0e0 AS time_eas FROM tx",
    "nr_of_bank_accounts": "SELECT player, count(DISTINCT account) AS nr_of_bank_accounts FROM account GROUP BY player",
    "nr_of_risk_classes": "SELECT player, count(DISTINCT class) AS nr_of_risk_classes FROM risk GROUP BY player",
    "complaint_variance": f"""SELECT player, count(*) AS number_of_complaints, {_r('coalesce(var_samp(CAST(n AS DOUBLE)), 0)')} AS variance_in_number_of_responses_per_complaint
        FROM (SELECT c.player, c.complaint_id, count(DISTINCT r.response_id) AS n FROM complaint c LEFT JOIN response r ON c.row_id = r.row_id GROUP BY c.player, c.complaint_id) c GROUP BY player""",
}

BASE = ("tx", "bet", "bet_link", "leg", "ses", "ses_link", "game", "prof", "lim", "club", "account", "risk", "complaint", "response", "contact")


def needed(name: str, given: frozenset[str] = frozenset(), extra: dict[str, str] | None = None) -> tuple[list[str], list[str]]:
    """(plans, tables) that plan ``name`` reads, plans in order of dependence.

    Plans in ``given`` count as tables; ``extra`` holds plans beside the named ones.
    """
    plans: list[str] = []
    base: list[str] = []
    known = {**VIEWS, **FEATURES, **(extra or {})}

    def add(n: str) -> None:
        for x in re.findall(r"\b(?:FROM|JOIN)\s+([a-z][a-z0-9_]*)", known[n]):
            if x in BASE or x in given:
                if x not in base:
                    base.append(x)
            elif x != n and x in known and x not in plans:
                add(x)
                plans.append(x)

    add(name)
    return plans, base


_ONE_PASS = re.compile(r"SELECT player, (.+?) FROM ([a-z_]+(?: WHERE .+?)?) GROUP BY player", re.S)


def fuse(keys: list[str]) -> tuple[list[str], dict[str, str]]:
    """(names of plans, plans beside the named ones) that give the columns of ``keys``.

    Features that aggregate the same rows per player become one aggregation.
    """
    groups: dict[str, list[str]] = {}
    names: list[str] = []
    for k in keys:
        m = _ONE_PASS.fullmatch(FEATURES[k])
        if m and "SELECT" not in m[1] and " JOIN " not in m[2] and "SELECT" not in m[2]:
            groups.setdefault(m[2], []).append(m[1])
        else:
            names.append(k)
    extra = {f"fused_{i}": f"SELECT player, {', '.join(cols)} FROM {source} GROUP BY player" for i, (source, cols) in enumerate(groups.items())}
    return [*extra, *names], extra


#: What the two engines spell differently.
_SPARK = {
    "q25": "percentile(gap, 0.25)",
    "q75": "percentile(gap, 0.75)",
    "club_list": "collect_list(named_struct('club', upper(club), 'country', country))",
    "named_countries": "transform(filter(clubs, c -> contains(event, c.club)), c -> c.country)",
    "each_country": "explode_outer(c.countries)",
    "at_home": "array_contains(countries, {home})",
    "nulls_last": " NULLS LAST",
}
_DUCKDB = {
    "q25": "quantile_cont(gap, 0.25)",
    "q75": "quantile_cont(gap, 0.75)",
    "club_list": "list({'club': upper(club), 'country': country})",
    "named_countries": "list_transform(list_filter(clubs, lambda c: contains(event, c.club)), lambda c: c.country)",
    "each_country": "unnest(CASE WHEN len(c.countries) = 0 THEN [NULL] ELSE c.countries END)",
    "at_home": "list_contains(countries, {home})",
    "nulls_last": "",  # as it is there
}


def _plain_counts(sql: str) -> str:
    """count_if(x) as count(CASE WHEN x THEN 1 END)."""
    while (at := sql.find("count_if(")) >= 0:
        end, depth = at + 9, 1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        sql = f"{sql[:at]}count(CASE WHEN {sql[at + 9 : end - 1]} THEN 1 END){sql[end:]}"
    return sql


def compose(name: str, numbers: dict[str, object], engine: str = "spark", given: frozenset[str] = frozenset(), extra: dict[str, str] | None = None) -> tuple[str, str, list[str]]:
    """(common table expressions, query, names of the tables that it reads)."""
    plans, base = needed(name, given, extra)
    known = {**VIEWS, **FEATURES, **(extra or {})}
    values = {**numbers, **(_SPARK if engine == "spark" else _DUCKDB)}

    def fill(plan: str) -> str:
        sql = re.sub(r"\{(\w+)\}", lambda m: str(values[m[1]]), re.sub(r"\{(\w+)\}", lambda m: str(values[m[1]]), known[plan]))
        return sql if engine == "spark" else _plain_counts(sql)  # there count_if is wider than bigint

    return ",\n".join(f"{p} AS ({fill(p)})" for p in plans), fill(name), base

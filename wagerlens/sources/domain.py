"""The domain tables, as adapters over the benchmark's star schema.

Every table has integer time columns beside the timestamps: ``us`` (microseconds since
the epoch, UTC), ``dayno`` and ``hour`` (civil time of ``ZONE``). Features only use these,
so they don't depend on the session's time zone.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagerlens.functions import json_readers
from wagerlens.operators.links import KINDS, limit_events

ZONE = "Europe/Amsterdam"
#: Moves the dates of orders to the years that the windows lie in.
SHIFT_US = 788918400000000

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def with_time(df: DataFrame, ts: str) -> DataFrame:
    """Adds us, dayno, hour and dow (Monday 0) of the UTC timestamp column ``ts``."""
    local = f"convert_timezone('UTC', '{ZONE}', cast({ts} as timestamp_ntz))"
    return df.withColumns(
        {
            "us": F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, cast({ts} as timestamp_ntz))"),
            "dayno": F.expr(f"cast(datediff(to_date({local}), date'1970-01-01') as bigint)"),
            "hour": F.expr(f"cast(hour({local}) as bigint)"),
            "dow": F.expr(f"cast(weekday(to_date({local})) as bigint)"),
        }
    )


def domain_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """tx, bet, bet_link, leg, ses, ses_link, game, prof, lim, club, account, risk, complaint, response, contact.

    Accounts, risk classes and responses are made as the extracts have them, JSON in
    several spellings, and read by the lenient readers; limits come as a header and a
    child table of each kind.
    """
    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    events = read("events").select(
        "event_id", "user_id", "ts", "event_type", "value", F.get_json_object("props", "$.k").cast("long").alias("k")
    )
    tx = with_time(
        events.selectExpr(
            "user_id as player",
            "event_id as tx_id",
            "user_id % 3 as operator",
            "ts",
            "k",
            """case event_type when 'purchase' then 'STAKE' when 'click' then 'WINNING' when 'signup' then 'DEPOSIT' when 'view' then 'WITHDRAWAL'
               else case k % 4 when 0 then 'VOID_BET' when 1 then 'CASH_OUT' when 2 then 'VOID_STAKE' else 'OTHER' end end as type""",
            "case when k % 5 = 0 then 'UNSUCCESSFUL' else 'SUCCESSFUL' end as status",
            "value as amount",
            "case k % 4 when 0 then 'CREDIT_CARD' when 1 then 'ELECTRONIC_MONEY' when 2 then 'BANK_TRANSFER' else 'OTHER' end as instrument",
        ),
        "ts",
    )
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("player").orderBy("us", "tx_id")) - 1
    grouped = tx.withColumn("g", F.floor(place / 3).cast("long")).withColumn("pk", F.col("player") * 1_000_000 + F.col("g"))
    heads = grouped.groupBy("pk", "player", "operator", "g").agg(F.min("us").alias("us"), F.min("k").alias("k"), F.sum("amount").alias("stake"))
    bet = heads.filter("g % 2 = 0").selectExpr(
        "pk",
        "operator",
        "pk as bet_id",
        "us",
        "case k % 4 when 0 then 'BET_PLACED' when 1 then 'BET_SETTLED' when 2 then 'BET_CANCELLED' else 'BET_UPDATED' end as status",
        "us + (k % 90 + 1) * 60000000 as extracted_us",
        "stake",
    )
    ses = heads.filter("g % 2 = 1").selectExpr("pk", "operator", "pk as session_id", "us", "k % 24 as game_id", "k % 7 as rounds", "us + (k % 200 - 10) * 60000000 as end_us")
    civil = "convert_timezone('UTC', '" + ZONE + "', timestampadd(MICROSECOND, us, " + _EPOCH + "))"
    bet, ses = (d.withColumn("hour", F.expr(f"hour({civil})")) for d in (bet, ses))
    link = grouped.select("pk", "player", "tx_id", "operator", "g", "k")
    nations = read("nation").selectExpr("n_nationkey as id", "upper(n_name) as name", "n_regionkey as region")
    legs = link.filter("g % 2 = 0").join(F.broadcast(nations), F.col("k") % 25 == F.col("id"))  # 25 rows
    leg = legs.selectExpr(
        "pk",
        "tx_id as part_id",
        "concat('FC ', name, ' - Visitors') as event",
        "case k % 6 when 0 then 'Football' when 1 then 'Tennis' when 2 then 'Voetbal' when 3 then 'Soccer' else 'Basketball' end as sport",
        "1 + k / 20 as odds",
        "cast(k % 2 as string) as live",
    )
    prof = read("orders").selectExpr(
        "o_custkey as player",
        "o_orderkey as pk",
        "o_custkey % 3 as operator",
        f"timestampdiff(MICROSECOND, {_EPOCH}, o_orderdate) + 788918400000000 as modified_us",
        f"timestampdiff(MICROSECOND, {_EPOCH}, o_orderdate) + 788918400000000 + (o_orderkey % 3) * 86400000000 as extracted_us",
        "case o_orderstatus when 'F' then 'SELF_EXCLUDED_TEMP' when 'O' then 'ACTIVE' else 'SUSPENDED' end as status",
        "round(o_totalprice % 200, 2) as eod_balance",
        "(1930 + o_custkey % 85) * 10000 + (1 + o_custkey % 12) * 100 + 1 + o_custkey % 28 as dob",
    )
    lines = read("lineitem").selectExpr(
        "l_orderkey as limit_pk",
        "case l_linenumber % 4 when 0 then case when l_orderkey % 5 = 0 then 'PARTICIPATION' else 'DEPOSIT' end when 1 then 'DEPOSIT' when 2 then 'LOGIN' else case when l_orderkey % 9 = 0 then 'GAME_TYPE' else 'BALANCE' end end as kind",
        f"timestampdiff(MICROSECOND, {_EPOCH}, l_shipdate) + {SHIFT_US} + (l_orderkey % 3) * 400000 as us",
        "l_quantity as value",
        "case l_partkey % 4 when 0 then 'day' when 1 then 'DAILY' when 2 then 'Week' end as span",
    )
    headers = read("orders").selectExpr("o_orderkey as pk", "case when o_orderkey % 13 > 0 then o_custkey end as player")
    lim = limit_events(headers, {k: lines.filter(F.col("kind") == k).drop("kind") for k in KINDS})
    raw_accounts = read("customer").selectExpr(
        "c_custkey as player",
        """case c_custkey % 4 when 0 then concat('[{"Bank_Account_ID":"a', c_custkey % 50, '"},{"Bank_Account_ID":"b', c_custkey, '"},{"Bank_Account_ID":""}]')
           when 1 then concat("{'Bank_Account_ID': 'a", c_custkey % 50, "'}") when 2 then concat('[{""Bank_Account_ID"":""c', c_custkey, '""}]') else 'null' end as accounts""",
    )
    orders = read("orders").selectExpr("o_orderkey as row_id", "o_custkey as player", f"timestampdiff(MICROSECOND, {_EPOCH}, o_orderdate) + {SHIFT_US} as us")
    raw_risk = orders.selectExpr("player", """case row_id % 4 when 0 then '"{""RG_Class_Value"": ""NO_RISK"", ""RG_Class_Datetime"": ""2017""}"' when 1 then '{"RG_Class_Value": "LOW"}' when 2 then "{'RG_Class_Value': 'HIGH'}" else '[]' end as flag""")
    complaints = orders.filter("row_id % 7 = 0").selectExpr("row_id", "player", "concat('c', row_id % 40) as complaint_id", "us", """case row_id % 4 when 0 then '[{"Response": null}]'
        else concat('[{"Response":[', array_join(transform(sequence(1, cast(row_id % 4 as int)), i -> concat('{"Response_ID":"r', i, '"}')), ','), ']}]') end as responses""")
    return {
        "tx": tx,
        "bet": bet,
        "bet_link": link.filter("g % 2 = 0").select("pk", "player", "tx_id"),
        "leg": leg,
        "ses": ses,
        "ses_link": link.filter("g % 2 = 1").select("pk", "player", "tx_id"),
        "game": spark.range(24).selectExpr("id as game_id", "case id % 5 when 0 then 'SLOTS' when 1 then 'CASINO' when 2 then 'BINGO' when 3 then 'VIRTUAL_SPORTS' else 'TABLE' end as type", "concat('game ', id % 9) as name"),
        "prof": prof,
        "lim": lim,
        "club": nations.selectExpr("name as club", "region as country"),
        "account": raw_accounts.select("player", F.explode(json_readers.bank_accounts(F.col("accounts"))).alias("account")),
        "risk": raw_risk.select("player", json_readers.risk_class(F.col("flag")).alias("class")).filter("class is not null"),
        "complaint": complaints.drop("responses"),
        "response": complaints.select("row_id", F.explode(json_readers.response_ids(F.col("responses"))).alias("response_id")),
        "contact": orders.filter("row_id % 11 = 0").select("player", "us"),
    }


#: The same adapters in DuckDB's SQL, for the oracle.
ORACLE_CTES = {
    "ev": "SELECT event_id, user_id, ts, event_type, value, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events",
    "tx": """SELECT user_id AS player, event_id AS tx_id, user_id % 3 AS operator, ts, k,
        CASE event_type WHEN 'purchase' THEN 'STAKE' WHEN 'click' THEN 'WINNING' WHEN 'signup' THEN 'DEPOSIT' WHEN 'view' THEN 'WITHDRAWAL'
          ELSE CASE k % 4 WHEN 0 THEN 'VOID_BET' WHEN 1 THEN 'CASH_OUT' WHEN 2 THEN 'VOID_STAKE' ELSE 'OTHER' END END AS type,
        CASE WHEN k % 5 = 0 THEN 'UNSUCCESSFUL' ELSE 'SUCCESSFUL' END AS status, value AS amount,
        CASE k % 4 WHEN 0 THEN 'CREDIT_CARD' WHEN 1 THEN 'ELECTRONIC_MONEY' WHEN 2 THEN 'BANK_TRANSFER' ELSE 'OTHER' END AS instrument,
        epoch_us(ts) AS us,
        date_diff('day', DATE '1970-01-01', CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Amsterdam' AS DATE)) AS dayno,
        extract(hour FROM ts AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Amsterdam') AS hour,
        isodow(ts AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Amsterdam') - 1 AS dow
        FROM ev""",
    "grouped": "SELECT *, CAST(floor((row_number() OVER (PARTITION BY player ORDER BY us, tx_id) - 1) / 3) AS BIGINT) AS g FROM tx",
    "heads": "SELECT player * 1000000 + g AS pk, player, operator, g, min(us) AS us, min(k) AS k, sum(amount) AS stake FROM grouped GROUP BY player, operator, g",
    "bet": """SELECT pk, operator, pk AS bet_id, us, CASE k % 4 WHEN 0 THEN 'BET_PLACED' WHEN 1 THEN 'BET_SETTLED' WHEN 2 THEN 'BET_CANCELLED' ELSE 'BET_UPDATED' END AS status,
        us + (k % 90 + 1) * 60000000 AS extracted_us, stake, extract(hour FROM make_timestamp(us) AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Amsterdam') AS hour FROM heads WHERE g % 2 = 0""",
    "ses": """SELECT pk, operator, pk AS session_id, us, k % 24 AS game_id, k % 7 AS rounds, us + (k % 200 - 10) * 60000000 AS end_us,
        extract(hour FROM make_timestamp(us) AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Amsterdam') AS hour FROM heads WHERE g % 2 = 1""",
    "bet_link": "SELECT player * 1000000 + g AS pk, player, tx_id FROM grouped WHERE g % 2 = 0",
    "ses_link": "SELECT player * 1000000 + g AS pk, player, tx_id FROM grouped WHERE g % 2 = 1",
    "leg": """SELECT player * 1000000 + g AS pk, tx_id AS part_id, 'FC ' || upper(n_name) || ' - Visitors' AS event,
        CASE k % 6 WHEN 0 THEN 'Football' WHEN 1 THEN 'Tennis' WHEN 2 THEN 'Voetbal' WHEN 3 THEN 'Soccer' ELSE 'Basketball' END AS sport, 1 + k / 20 AS odds, CAST(k % 2 AS VARCHAR) AS live
        FROM grouped JOIN nation ON k % 25 = n_nationkey WHERE g % 2 = 0""",
    "game": """SELECT range AS game_id, CASE range % 5 WHEN 0 THEN 'SLOTS' WHEN 1 THEN 'CASINO' WHEN 2 THEN 'BINGO' WHEN 3 THEN 'VIRTUAL_SPORTS' ELSE 'TABLE' END AS type,
        'game ' || (range % 9) AS name FROM range(24)""",
    "prof": """SELECT o_custkey AS player, o_orderkey AS pk, o_custkey % 3 AS operator, epoch_us(o_orderdate) + 788918400000000 AS modified_us,
        epoch_us(o_orderdate) + 788918400000000 + (o_orderkey % 3) * 86400000000 AS extracted_us,
        CASE o_orderstatus WHEN 'F' THEN 'SELF_EXCLUDED_TEMP' WHEN 'O' THEN 'ACTIVE' ELSE 'SUSPENDED' END AS status, round(o_totalprice % 200, 2) AS eod_balance,
        (1930 + o_custkey % 85) * 10000 + (1 + o_custkey % 12) * 100 + 1 + o_custkey % 28 AS dob FROM orders""",
    "lim": """SELECT player, kind, us, CASE WHEN kind <> 'GAME_TYPE' THEN value END AS value, CASE WHEN kind <> 'BALANCE' THEN span END AS span FROM (
        SELECT o_custkey AS player, CASE WHEN l_linenumber % 4 = 1 THEN 'DEPOSIT' WHEN l_linenumber % 4 = 2 THEN 'LOGIN' WHEN l_linenumber % 4 = 3 AND l_orderkey % 9 = 0 THEN 'GAME_TYPE' WHEN l_linenumber % 4 = 3 THEN 'BALANCE'
            WHEN l_orderkey % 5 = 0 THEN 'PARTICIPATION' ELSE 'DEPOSIT' END AS kind, epoch_us(l_shipdate) + 788918400000000 + (l_orderkey % 3) * 400000 AS us, l_quantity AS value,
        CASE l_partkey % 4 WHEN 0 THEN 'DAY' WHEN 1 THEN 'DAILY' WHEN 2 THEN 'WEEK' END AS span FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderkey % 13 > 0) x""",
    "account": """SELECT c_custkey AS player, 'a' || (c_custkey % 50) AS account FROM customer WHERE c_custkey % 4 IN (0, 1) UNION ALL SELECT c_custkey, 'b' || c_custkey FROM customer WHERE c_custkey % 4 = 0
        UNION ALL SELECT c_custkey, 'c' || c_custkey FROM customer WHERE c_custkey % 4 = 2""",
    "risk": "SELECT o_custkey AS player, CASE o_orderkey % 4 WHEN 0 THEN 'NO_RISK' WHEN 1 THEN 'LOW' ELSE 'HIGH' END AS class FROM orders WHERE o_orderkey % 4 < 3",
    "complaint": "SELECT o_orderkey AS row_id, o_custkey AS player, 'c' || (o_orderkey % 40) AS complaint_id, epoch_us(o_orderdate) + 788918400000000 AS us FROM orders WHERE o_orderkey % 7 = 0",
    "response": "SELECT o_orderkey AS row_id, 'r' || i AS response_id FROM orders JOIN range(1, 4) t(i) ON i <= o_orderkey % 4 WHERE o_orderkey % 7 = 0",
    "contact": "SELECT o_custkey AS player, epoch_us(o_orderdate) + 788918400000000 AS us FROM orders WHERE o_orderkey % 11 = 0",
    "club": "SELECT upper(n_name) AS club, n_regionkey AS country FROM nation",
}
#: Which adapters an adapter reads.
ORACLE_NEEDS = {"tx": ["ev"], "grouped": ["tx"], "heads": ["grouped"], "bet": ["heads"], "ses": ["heads"], "bet_link": ["grouped"], "ses_link": ["grouped"], "leg": ["grouped"]}


@lru_cache(maxsize=None)
def oracle_order(names: tuple[str, ...]) -> tuple[str, ...]:
    """The adapters that ``names`` need, each after what it reads."""
    out: list[str] = []

    def add(name: str) -> None:
        for x in ORACLE_NEEDS.get(name, ()):
            add(x)
        if name not in out:
            out.append(name)

    for n in names:
        add(n)
    return tuple(out)

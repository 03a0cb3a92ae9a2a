"""Links between tables: limits of five kinds with their players, owners of movements."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds of limits, one child table each. The first four are numbers, the last is free text.
KINDS = ("PARTICIPATION", "DEPOSIT", "LOGIN", "BALANCE", "GAME_TYPE")


def limit_owners(parents: DataFrame, pk: str = "pk", player: str = "player") -> DataFrame:
    """(pk, player) of the limit headers that have a player; of several the largest."""
    return parents.filter(F.col(player).isNotNull()).groupBy(F.col(pk).alias("pk")).agg(F.max(player).alias("player"))


def limit_events(parents: DataFrame, children: dict[str, DataFrame]) -> DataFrame:
    """player, kind, us, value, text, span of all kinds of limits; children without a known player go.

    A child has limit_pk, us, value and, but for balances, span. Spans are in capitals;
    a balance has none, so that all balances of a player are one stream.
    """
    rows = []
    for kind in KINDS:
        if kind not in children:
            continue
        child = children[kind]
        number = F.lit(None).cast("double") if kind == "GAME_TYPE" else F.col("value").try_cast("double")
        span = F.upper("span") if "span" in child.columns and kind != "BALANCE" else F.lit(None).cast("string")
        rows.append(child.select("limit_pk", F.lit(kind).alias("kind"), "us", number.alias("value"), F.when(number.isNull(), F.col("value").cast("string")).alias("text"), span.alias("span")))
    every = reduce(DataFrame.unionByName, rows)
    return every.join(limit_owners(parents).withColumnRenamed("pk", "limit_pk"), "limit_pk").select("player", "kind", "us", "value", "text", "span")


def owners_of_movements(entries: DataFrame, tx: str = "tx_id", player: str = "player", order: tuple[str, ...] = ("us", "pk")) -> DataFrame:
    """(tx_id, player) by the first entry, in ``order``, that names a player."""
    known = entries.filter(F.col(tx).isNotNull() & F.col(player).isNotNull())
    return known.groupBy(F.col(tx).alias("tx_id")).agg(F.min_by(player, F.struct(*order, player)).alias("player"))

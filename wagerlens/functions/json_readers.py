"""Lenient readers of the JSON columns of the raw extracts, as column expressions.

Every reader takes a text column and gives an array; what can't be read gives an empty
one. An object is read as a map from key to text (nested values stay JSON text), so
that alternative spellings of a key are one ``coalesce``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wagerlens.functions.coerce import MISSING, relaxed_json

# The key spellings of the extracts.
TX_KEYS = ("Transaction_ID", "TransactionId", "TxId")
PLAYER_KEYS = ("Player_Profile_ID", "PlayerId", "Player_ID")
NESTED_TX = ("Transaction", "Transactions")
FLAT_TX = ("Game_Transaction", "Transactions", "Transaction")
#: kind: (time keys in order, value key, window key)
LIMIT_KEYS = {
    "deposit": (("Deposit_Request_Datetime", "Deposit_Start_Datetime"), "Deposit_Amount", "Deposit_Time_Window"),
    "login": (("Login_Request_Datetime", "Login_Start_Datetime"), "Login_Duration", "Login_Time_Window"),
    "balance": (("Balance_Request_Datetime", "Balance_Start_Datetime"), "Balance_Amount", None),
    "participation": (("Participation_Request_Datetime", "Participation_Start_Datetime"), "Participation_Amount", "Participation_Time_Window"),
    "game_type": (("Game_Type_Request_Datetime", "Game_Type_Start_Datetime"), "Game_Type_Type", "Game_Type_Time_Window"),
}
LIVE = ("true", "t", "1", "yes", "y")
NOT_LIVE = ("false", "f", "0", "no", "n")

_MAP = "map<string,string>"


def _object(text: Column) -> Column:
    """The object as a map; null where the text is no object."""
    return F.when(F.ltrim(text).startswith("{"), F.from_json(text, _MAP))


def _listed(text: Column) -> Column:
    """The objects of a JSON list, other elements left out; null where the text is no list."""
    return F.when(F.ltrim(text).startswith("["), F.filter(F.transform(F.from_json(text, "array<string>"), _object), lambda m: m.isNotNull()))


def _none(kind: str) -> Column:
    return F.from_json(F.lit("[]"), f"array<{kind}>")


def _first(record: Column, keys: tuple[str, ...]) -> Column:
    """The first key's value that is known and not empty."""
    return F.coalesce(*(F.nullif(record[k], F.lit("")) for k in keys))


def records(c: Column) -> Column:
    """The objects of a list, or the single object."""
    text = relaxed_json(c)
    return F.coalesce(_listed(text), F.transform(F.array(_object(text)), lambda m: m), _none(_MAP))


def _entries(objects: Column) -> Column:
    pairs = F.transform(objects, lambda m: F.struct(_first(m, TX_KEYS).alias("tx_id"), _first(m, PLAYER_KEYS).alias("player")))
    return F.filter(pairs, lambda e: e["tx_id"].isNotNull())


def transaction_entries(c: Column) -> Column:
    """(tx_id, player) of a list, an object that holds one under a known key, or a single entry."""
    text = relaxed_json(c)
    whole = _object(text)
    inner = _object(whole["Game_Transactions"])
    nested = F.coalesce(*(_listed(inner[k]) for k in NESTED_TX))
    flat = F.coalesce(*(_listed(whole[k]) for k in FLAT_TX))
    single = F.when(whole.isNotNull(), F.array(whole))
    return F.coalesce(_entries(F.coalesce(_listed(text), nested, flat, single)), _none("struct<tx_id:string,player:string>"))


def strict_transaction_entries(c: Column) -> Column:
    """(tx_id, player) of ``{"Game_Transaction": [...]}`` only, as valid JSON."""
    return F.coalesce(_entries(_listed(_object(F.trim(c.cast("string")))["Game_Transaction"])), _none("struct<tx_id:string,player:string>"))


def bank_accounts(c: Column) -> Column:
    """Ids of bank accounts of a list or of a single object."""
    return F.filter(F.transform(records(c), lambda m: F.nullif(m["Bank_Account_ID"], F.lit(""))), lambda x: x.isNotNull())


def risk_class(c: Column) -> Column:
    """The risk class of a single object, or null."""
    return F.nullif(_object(relaxed_json(c))["RG_Class_Value"], F.lit(""))


def _known(c: Column) -> Column:
    text = F.trim(c)
    return F.when(~F.lower(text).isin(*MISSING), text)


def limit_values(c: Column, kind: str) -> Column:
    """(ts, value, text, span) of one kind of limit: the request time, else the start time;
    decimal commas are points; ``text`` holds what is no number."""
    times, value, span = LIMIT_KEYS[kind]

    def one(m: Column) -> Column:
        raw = _known(m[value])
        number = F.lit(None).cast("double") if kind == "game_type" else F.replace(raw, F.lit(","), F.lit(".")).try_cast("double")
        ts = F.coalesce(*(F.nullif(F.nullif(m[k], F.lit("")), F.lit("null")) for k in times))
        return F.struct(_known(ts).try_cast("timestamp").alias("ts"), number.alias("value"), F.when(number.isNull(), raw).alias("text"), (F.trim(m[span]) if span else F.lit(None).cast("string")).alias("span"))

    return F.transform(records(c), one)


def _parts(c: Column) -> Column:
    """Legs: under ``Part`` (a list or one object), a list, or one object."""
    text = relaxed_json(c)
    whole = _object(text)
    part = whole["Part"]
    held = F.when(F.map_contains_key(whole, F.lit("Part")), F.coalesce(_listed(part), F.array(_object(part))))
    return F.filter(F.coalesce(held, F.when(whole.isNotNull(), F.array(whole)), _listed(text), _none(_MAP)), lambda m: m.isNotNull())


def part_ids(c: Column) -> Column:
    return F.filter(F.transform(_parts(c), lambda m: F.nullif(m["Part_ID"], F.lit(""))), lambda x: x.isNotNull())


def live_flags(c: Column) -> Column:
    """Whether each leg is live; legs whose flag is missing or can't be read are left out."""

    def flag(m: Column) -> Column:
        text = F.lower(F.trim(m["Part_Live"]))
        return F.when(text.isin(*LIVE), True).when(text.isin(*NOT_LIVE), False).otherwise(text.try_cast("double").cast("int") != 0)

    return F.filter(F.transform(_parts(c), flag), lambda x: x.isNotNull())


def response_ids(c: Column) -> Column:
    """Ids under ``Response`` of every object of a list; null where there is no response,
    and an error for elements that are no objects."""
    text = F.replace(F.trim(c.cast("string")), F.lit('""'), F.lit('"'))
    none = text.isNull() | F.regexp_replace(text, r"[\s'\"]", "").isin("[{Response:null}]", "")
    items = F.from_json(text, "array<string>")
    bad = F.exists(items, lambda x: x.isNotNull() & ~F.ltrim(x).startswith("{"))
    found = F.flatten(F.transform(items, lambda x: F.coalesce(F.transform(_listed(_object(x)["Response"]), lambda r: r["Response_ID"]), F.array().cast("array<string>"))))
    return F.when(none | items.isNull() | F.exists(items, lambda x: x.isNull()), F.lit(None)).when(bad, F.raise_error(F.lit("responses hold an element that is no object"))).otherwise(found)


# ------------------------------------------------------------------ repair of the shapes that extracts deviate in


def json_parent(parent: Column, children: dict[str, Column], need_all: bool = False) -> Column:
    """The parent's JSON, else an object made of flat columns that are known (all, or at least one)."""
    known = {k: F.when(~F.lower(F.trim(v.cast("string"))).isin(*MISSING), v.cast("string")) for k, v in children.items()}
    several = [v.isNotNull() for v in known.values()]
    enough = several[0]
    for s in several[1:]:
        enough = (enough & s) if need_all else (enough | s)
    made = F.when(enough, F.to_json(F.struct(*(v.alias(k) for k, v in known.items()))))
    return F.coalesce(F.when(~F.lower(F.trim(parent.cast("string"))).isin(*MISSING), parent.cast("string")), made)


def wrapped_in_list(c: Column) -> Column:
    """A single object as a list of one; lists as they stand."""
    text = relaxed_json(c)
    return F.when(F.ltrim(text).startswith("{"), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)


def renamed_keys(c: Column, names: dict[str, str]) -> Column:
    """JSON text with keys renamed, wherever they stand."""
    text = relaxed_json(c)
    for old, new in names.items():
        text = F.regexp_replace(text, rf'"{old}"\s*:', f'"{new}":')
    return text


def flattened_parts(c: Column) -> Column:
    """``{"Part": [...]}`` from ``{"Parts": [{"Part": [...]}, ...]}``; other shapes as they stand."""
    text = relaxed_json(c)
    groups = _listed(_object(text)["Parts"])
    legs = F.flatten(F.transform(groups, lambda g: F.coalesce(F.from_json(g["Part"], "array<string>"), F.array(g["Part"]))))
    return F.when(groups.isNotNull(), F.concat(F.lit('{"Part": ['), F.array_join(F.filter(legs, lambda x: x.isNotNull()), ", "), F.lit("]}"))).otherwise(text)


def limit_object(c: Column, kind: str) -> Column:
    """A bare number as the list that holds a limit of this value; objects and lists as a list."""
    text = F.trim(c.cast("string"))
    value = LIMIT_KEYS[kind][1]
    bare = text.rlike(r"^-?\d+([.,]\d+)?$")
    return F.when(bare, F.concat(F.lit(f'[{{"{value}": '), F.replace(text, F.lit(","), F.lit(".")), F.lit("}]"))).otherwise(wrapped_in_list(c))

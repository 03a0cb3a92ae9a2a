"""Lenient parsing of the raw extracts as column expressions; what can't be read is null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MISSING = ("", "null", "none", "nan", "na", "n/a", "nat", "<na>")

_DATES = ("yyyy-MM-dd", "yyyy/MM/dd", "dd-MM-yyyy", "d/M/yyyy", "yyyyMMdd")
_TIMES = ("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]", "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS][XXX]", "d/M/yyyy HH:mm:ss", "yyyy-MM-dd")


def missing_to_null(c: Column) -> Column:
    text = F.trim(c.cast("string"))
    return F.when(F.lower(text).isin(*MISSING), F.lit(None)).otherwise(text)


def to_date(c: Column) -> Column:
    text = F.regexp_replace(missing_to_null(c), r"[T ].*$", "")
    return F.coalesce(*(F.to_date(F.try_to_timestamp(text, F.lit(f))) for f in _DATES))


def to_utc_seconds(c: Column) -> Column:
    """UTC time without fractions, as yyyy-MM-ddTHH:mm:ssZ; text without an offset is UTC."""
    text = missing_to_null(c)
    ts = F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in _TIMES))
    return F.date_format(F.date_trunc("second", ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def to_bool(c: Column) -> Column:
    text = F.lower(missing_to_null(c))
    return F.when(text.isin("true", "1"), True).when(text.isin("false", "0"), False)


def to_int(c: Column) -> Column:
    text = F.regexp_replace(missing_to_null(c), r"\.0+$", "")
    return F.when(text.rlike(r"^-?\d+$"), text.try_cast("bigint"))


def to_number(c: Column) -> Column:
    """Decimal point or, where it is the only mark, decimal comma."""
    text = missing_to_null(c)
    return F.when(text.rlike(r"^-?\d+([.,]\d+)?$"), F.replace(text, F.lit(","), F.lit(".")).try_cast("double"))


def to_identifier(c: Column) -> Column:
    """Ids are text; a trailing .0 of a number read as a float goes."""
    return F.regexp_replace(missing_to_null(c), r"^(-?\d+)\.0+$", "$1")


def relaxed_json(c: Column) -> Column:
    """JSON text from the plain, quoted, doubled-quote or single-quoted forms of the extracts."""
    plain = F.regexp_replace(F.trim(c.cast("string")), r'^"(.*)"$', "$1")
    doubled = F.replace(plain, F.lit('""'), F.lit('"'))
    single = F.replace(F.replace(doubled, F.lit("'"), F.lit('"')), F.lit("None"), F.lit("null"))
    return F.coalesce(*(F.when(F.try_parse_json(text).isNotNull(), text) for text in (plain, doubled, single)))


def json_list(c: Column, fields: dict[str, str]) -> Column:
    """An array of structs from a JSON list, or from one object."""
    kind = ", ".join(f"{k}: {v}" for k, v in fields.items())
    text = relaxed_json(c)
    listed = F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    return F.from_json(listed, f"array<struct<{kind}>>")


def clean(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """All columns trimmed, missing tokens nulled, and those in ``types`` coerced."""
    ways = {"date": to_date, "datetime": to_utc_seconds, "bool": to_bool, "int": to_int, "number": to_number, "id": to_identifier, "text": missing_to_null}
    return df.select(*(ways[types.get(c, "text")](F.col(c)).alias(c) for c in df.columns))


def violations(df: DataFrame, types: dict[str, str], required: list[str]) -> DataFrame:
    """One row: per typed column the values that can't be read, per required column the missing ones."""
    done = clean(df, types)
    marked = df.select(*(F.col(c).alias(f"__{c}") for c in df.columns), *(w.alias(c) for c, w in zip(done.columns, [_way(types.get(c, "text"))(F.col(c)) for c in df.columns], strict=True)))
    bad = [F.count_if(F.col(c).isNull() & missing_to_null(F.col(f"__{c}")).isNotNull()).alias(f"{c}_unreadable") for c in types]
    gone = [F.count_if(missing_to_null(F.col(f"__{c}")).isNull()).alias(f"{c}_missing") for c in required]
    return marked.agg(*bad, *gone)


def _way(kind: str):
    return {"date": to_date, "datetime": to_utc_seconds, "bool": to_bool, "int": to_int, "number": to_number, "id": to_identifier, "text": missing_to_null}[kind]

"""The cleaning job: tenant rules, typed columns with a report, and tables passed on as they are.

A type specification lists the types that a column may have, in the order in which they
are tried, and whether it may be null or missing: ``"dateTimeUTC|date|null|optional"``.
A value that no type accepts stays as it stands and is counted; missing tokens become
null. Cleaning and counting are one scan each, and nothing is logged row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagerlens.functions import coerce

# How the extracts spell types, and what counts as empty in tenant rules.
_TYPES = {
    "date": lambda c: F.date_format(coerce.to_date(c), "yyyy-MM-dd"),
    "datetimeutc": coerce.to_utc_seconds,
    "int": lambda c: coerce.to_int(c).cast("string"),
    "decimal": lambda c: F.when(F.trim(c).rlike(r"^-?\d+(\.\d+)?$"), F.trim(c)),
    "monetaryamount": lambda c: F.when(F.trim(c).rlike(r"^-?\d+(\.\d+)?$"), F.trim(c)),
    "boolean": lambda c: coerce.to_bool(c).cast("string"),
    "json": coerce.relaxed_json,
}
EMPTY = ("", "null", "NULL", "NaN", "N/A")


@dataclass(frozen=True)
class Spec:
    """Types in the order they are tried, whether null is allowed, whether the column may be absent."""

    types: tuple[str, ...]
    nullable: bool
    optional: bool


def parse_spec(text: str) -> Spec:
    parts = [p.strip() for p in text.split("|")]
    marks = {p.lower() for p in parts}
    types = tuple(p.removeprefix("meta:") for p in parts if p.lower() not in ("null", "optional"))
    return Spec(types, "null" in marks, "optional" in marks or any(p.startswith("meta:") for p in parts))


def typed(c: Column, spec: Spec) -> Column:
    """The value as the first type that accepts it; a type without a rule accepts any text."""
    ways = [_TYPES.get(t.lower(), coerce.missing_to_null)(c) for t in spec.types]
    return F.coalesce(*ways) if ways else coerce.missing_to_null(c)


def clean_table(df: DataFrame, schema: dict[str, str], check_only: bool = False) -> DataFrame:
    """All columns as trimmed text with missing tokens nulled, those of the schema coerced.

    Names match whatever their case. A required column that is absent is an error when
    cleaning; when only checking, ``violations`` reports it.
    """
    specs = {k.lower(): parse_spec(v) for k, v in schema.items()}
    absent = sorted(k for k, s in specs.items() if k not in {c.lower() for c in df.columns} and not s.optional)
    if absent and not check_only:
        raise ValueError(f"required columns are absent: {', '.join(absent)}")
    out = []
    for c in df.columns:
        kept = coerce.missing_to_null(F.col(c))
        spec = specs.get(c.lower())
        out.append((F.coalesce(typed(F.col(c), spec), kept) if spec else kept).alias(c.lower()))
    return df.select(*out)


def violations(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """One row per column of the schema: whether it is absent, its values that are missing though
    they may not be, and those that no type accepts; ``severity`` is none, warning or error."""
    given = {c.lower(): c for c in df.columns}
    each = []
    for name, text in schema.items():
        spec, c = parse_spec(text), given.get(name.lower())
        if c is None:
            gone = bad = F.lit(0).cast("long")
        else:
            empty = coerce.missing_to_null(F.col(c)).isNull()
            gone = F.count_if(empty) if not spec.nullable else F.count_if(F.lit(False))
            bad = F.count_if(~empty & typed(F.col(c), spec).isNull())
        severity = F.when(F.lit(c is None and not spec.optional), "error").when((gone + bad > 0) | F.lit(c is None), "warning").otherwise("none")
        each.append(F.struct(F.lit(name.lower()).alias("name"), F.lit(c is None).alias("absent"), gone.alias("missing"), bad.alias("unreadable"), severity.alias("severity")))
    return df.agg(F.array(*each).alias("r"), F.count("*").alias("n")).select(F.inline("r"))


# ------------------------------------------------------------------ tenant rules


@dataclass(frozen=True)
class Rule:
    """``drop`` rows whose column is empty, ``fill`` empty values, or ``reformat`` times."""

    kind: str
    column: str
    value: str = ""
    table: str = ""


#: Rules of the tenants that need any.
RULES: dict[str, tuple[Rule, ...]] = {
    "b": (Rule("drop", "transaction_amount"), Rule("fill", "game_session_rounds_won", "0")),
    "w": (
        Rule("reformat", "player_profile_registration_datetime", "MM/dd/yyyy HH:mm:ss", "player_profile"),
        Rule("reformat", "player_profile_dob", "MM/dd/yyyy HH:mm:ss", "player_profile"),
    ),
}


def _empty(c: Column) -> Column:
    return c.isNull() | F.trim(c.cast("string")).isin(*EMPTY)


def _rules(df: DataFrame, tenant: str, table: str) -> list[tuple[Rule, str]]:
    given = {c.lower(): c for c in df.columns}
    return [(r, given[r.column]) for r in RULES.get(tenant, ()) if r.column in given and r.table in table.lower()]


def tenant_filtered(df: DataFrame, tenant: str, table: str) -> DataFrame:
    """The table by the tenant's rules; a tenant without rules changes nothing."""
    out = df
    for rule, c in _rules(df, tenant, table):
        if rule.kind == "drop":
            out = out.filter(~_empty(F.col(c)))
        elif rule.kind == "fill":
            out = out.withColumn(c, F.when(_empty(F.col(c)), F.lit(rule.value)).otherwise(F.col(c)))
        else:
            out = out.withColumn(c, F.date_format(F.try_to_timestamp(F.col(c), F.lit(rule.value)), "yyyy-MM-dd HH:mm:ss"))
    return out


def tenant_report(df: DataFrame, tenant: str, table: str, most: float = 0.10) -> DataFrame:
    """One row per rule: rows that it drops or values that it sets, their share of all rows, and
    whether a rule drops more than ``most`` of them. Reads only, as a dry run."""
    each = []
    for rule, c in _rules(df, tenant, table):
        hit = F.try_to_timestamp(F.col(c), F.lit(rule.value)).isNotNull() if rule.kind == "reformat" else _empty(F.col(c))
        n = F.count_if(hit)
        share = F.coalesce(F.try_divide(n, F.count("*")), F.lit(0.0))
        each.append(F.struct(F.lit(rule.kind).alias("rule"), F.lit(rule.column).alias("column"), n.alias("n"), F.round(share, 6).alias("share"), (F.lit(rule.kind == "drop") & (share > most)).alias("too_many")))
    if not each:
        return df.sparkSession.createDataFrame([], "rule string, column string, n long, share double, too_many boolean")
    return df.agg(F.array(*each).alias("r")).select(F.inline("r"))


def passed_on(df: DataFrame) -> DataFrame:
    """A table in the relational format: text trimmed, missing tokens nulled, ids without a trailing .0."""
    ways = {c: coerce.to_identifier(F.col(c)) if c.lower().endswith("_id") or c.lower() == "pk_id" else coerce.missing_to_null(F.col(c)) for c in df.columns}
    return df.select(*(v.alias(c) for c, v in ways.items()))


def clean_job(df: DataFrame, schema: dict[str, str], path: str, tenant: str = "", table: str = "") -> DataFrame:
    """Tenant rules, then typed columns, written to a new place that takes the old one's name
    only when it is whole; gives the report."""
    from wagerlens.sources.sinks import swap_in

    filtered = tenant_filtered(df, tenant, table)
    swap_in(clean_table(filtered, schema), path)
    return violations(filtered, schema)

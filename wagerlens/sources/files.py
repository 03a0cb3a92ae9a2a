"""Readers of raw CSV extracts: format detection, table names, natural order of parts."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SKIP = ("cleaned", "archive", "logs", "test_", "daily_")


def natural_key(name: str) -> list:
    """Numbers in names by value, so that part 2 comes before part 10."""
    return [int(x) if x.isdigit() else x.lower() for x in re.split(r"(\d+)", name)]


def table_of(filename: str, tables: list[str]) -> str | None:
    """Canonical table of a file name: without folder, extension, part number and _out, any case."""
    stem = re.sub(r"(\.csv)(\.gz)?$", "", filename.rsplit("/", 1)[-1], flags=re.I)
    at = stem.upper().find("WOK_")
    stem = re.sub(r"\s+|_(?=_)", "", stem[at:] if at >= 0 else stem)
    while (cut := re.sub(r"(_out|_\d+|\[\d+\])$", "", stem, flags=re.I)) != stem:
        stem = cut
    return {t.lower(): t for t in tables}.get(stem.lower())


def csv_format(header: str) -> dict[str, str]:
    """Reader options from a header line: separator, and pipe quoting where values are wrapped in it."""
    sep = ";" if header.count(";") > header.count(",") else ","
    quote = "|" if re.match(rf"^\|[^|]*\|({re.escape(sep)}|$)", header.strip()) else '"'
    return {"sep": sep, "quote": quote, "escape": '"', "header": "true", "nullValue": "NULL", "encoding": "UTF-8"}


def read_table(spark: SparkSession, paths: list[str], columns: list[str] | None = None) -> DataFrame:
    """All parts of a table as text columns, with the file's place and name for tie-breaks.

    Formats are told from the first line of each part, which Spark reads; parts of one
    format are one scan. Wanted columns match in any case; missing ones are null.
    """
    by_format: dict[tuple, list[str]] = {}
    for p in sorted(paths, key=natural_key):
        head = spark.read.text(p).limit(1).collect()
        if head:
            by_format.setdefault(tuple(csv_format(head[0][0]).items()), []).append(p)
    out = None
    for options, parts in by_format.items():
        df = spark.read.options(**dict(options)).csv(parts)
        names = {c.strip().lstrip("﻿").lower(): c for c in df.columns}
        wanted = columns or [c.strip() for c in df.columns]
        df = df.select(*(F.trim(F.col(f"`{names[c.lower()]}`")).alias(c) if c.lower() in names else F.lit(None).cast("string").alias(c) for c in wanted), F.input_file_name().alias("source_file"))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError(f"no part with rows among {len(paths)} files")
    return out


def find_tables(names: list[str], tables: list[str]) -> dict[str, list[str]]:
    """Files by table, parts in natural order; folders of earlier runs are left out."""
    found: dict[str, list[str]] = {}
    for n in sorted(names, key=natural_key):
        if not any(part.startswith(_SKIP) for part in n.lower().split("/")):
            if t := table_of(n, tables):
                found.setdefault(t, []).append(n)
    return found


def requirements(columns: dict[str, dict[str, list[str]]]) -> list[tuple[str, str]]:
    """(table, column) that any of the features needs, each once."""
    return sorted({(t, c) for need in columns.values() for t, cs in need.items() for c in cs})


def newest(spark: SparkSession, folder: str, pattern: str, by: str = "name") -> str | None:
    """Path of the newest entry of a folder whose name matches: by its name (time stamps), or by ``by="time"``."""
    here = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = here.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(here):
        return None
    found = [(natural_key(e.getPath().getName()) if by == "name" else e.getModificationTime(), str(e.getPath())) for e in fs.listStatus(here) if re.fullmatch(pattern, e.getPath().getName())]
    return max(found)[1] if found else None


def missing_tables(found: dict[str, list[str]], tables: list[str]) -> list[str]:
    """Tables without a file."""
    return [t for t in tables if not found.get(t)]


def decimal_points(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text with a decimal comma as text with a point, where it is a number."""
    return df.withColumns({c: F.when(F.col(c).rlike(r"^-?\d+,\d+$"), F.replace(F.col(c), F.lit(","), F.lit("."))).otherwise(F.col(c)) for c in columns})

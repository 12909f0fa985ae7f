"""Cleaning driven by a table declaration or by column metadata, without a loop of projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.dates import cyymmdd_to_date
from quire.functions.text import strip_controls, trim_fixed
from quire.functions.types import spark_type_name, typed
from quire.model.fields import SourceTable
from quire.operators.dedupe import keep_latest

FIXED_WIDTH_TYPES = ("CHAR", "GRAPHIC")
FRENCH_EBCDIC = 297


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add derived columns that a later filter must not derive again.

    Catalyst pushes a filter on a projected column below the projection, with the column's expression in
    place of every mention; a filter shares no subexpressions, so a checksum would trim and parse its text
    a dozen times and outgrow the JVM's compile limit. Filters stay above a generator's output, and inside
    it the expression is evaluated once.
    """
    values = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(values)))


def to_raw(df: DataFrame, table: SourceTable) -> DataFrame:
    """Bronze: the declared columns in order with their declared types, text left as it is."""
    return df.select([F.col(f.source).try_cast(f.raw_type).alias(f.source) for f in table.fields])


def pad_fixed(df: DataFrame, table: SourceTable) -> DataFrame:
    """Pad text to the declared width, as a fixed-width source delivers it."""
    return df.select(
        [
            F.rpad(f.source, f.length, " ").alias(f.source) if f.kind == "char" else F.col(f.source)
            for f in table.fields
        ]
    )


def clean(df: DataFrame, table: SourceTable) -> DataFrame:
    """Trim, decode, cast and rename every declared column; no shuffle.

    Decoded dates are what reports filter on, so they are computed once.
    """
    coded = [f for f in table.fields if f.kind == "cyymmdd"]
    plain = df.select([F.col(f.source) if f in coded else f.cleaned() for f in table.fields])
    if not coded:
        return plain
    dated = computed_once(plain, **{f.name: f.cleaned() for f in coded})
    return dated.select([f.name for f in table.fields])


def _is_coded_date(meta: dict) -> bool:
    return "CYYMMDD" in (meta.get("format") or "")


def _cleaned_by(meta: dict) -> Column:
    value = F.col(meta["name"])
    source_type = meta["type"].upper()
    if source_type in FIXED_WIDTH_TYPES:
        value = trim_fixed(value)
    if meta.get("ccsid") == FRENCH_EBCDIC:
        value = strip_controls(value)
    target = meta.get("spark_type") or spark_type_name(
        source_type, meta.get("length") or 0, meta.get("scale") or 0
    )
    if target != "STRING":
        value = typed(value, target)
    return value.alias(meta["name"].lower())


def clean_by_metadata(
    df: DataFrame, columns: list[dict], newest_by: tuple[str, ...] = ()
) -> DataFrame:
    """Clean from discovered metadata (name, type, length, scale, ccsid, format, is_pk).

    The format decides on date decoding, because the coded dates are declared as decimals. Columns
    come out in lower case; a declared key is deduplicated, the newest row by `newest_by` stays.
    """
    names = [meta["name"].lower() for meta in columns]
    # Coded dates keep their raw value under another name until they are decoded.
    raw = {meta["name"].lower(): f"_raw_{meta['name'].lower()}" for meta in columns if _is_coded_date(meta)}
    cleaned = df.select(
        [
            F.col(meta["name"]).alias(raw[name]) if name in raw else _cleaned_by(meta)
            for name, meta in zip(names, columns)
        ]
    )
    if raw:
        decoded = {name: cyymmdd_to_date(source) for name, source in raw.items()}
        cleaned = computed_once(cleaned, **decoded).select(names)
    keys = [meta["name"].lower() for meta in columns if meta.get("is_pk")]
    return keep_latest(cleaned, keys, newest_by) if keys else cleaned

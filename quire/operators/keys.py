"""Surrogate keys that stay the same between runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_surrogate_key(df: DataFrame, name: str, natural_key: list[str]) -> DataFrame:
    """A 64-bit key hashed from the natural key as first column; needs no sort and no shared counter."""
    parts = [p for c in natural_key for p in (F.col(c), F.col(c).isNull())]
    return df.select(F.xxhash64(*parts).alias(name), *[F.col(c) for c in df.columns])


def key_collisions(df: DataFrame, name: str, natural_key: list[str]) -> DataFrame:
    """Surrogate keys that stand for more than one natural key; empty when the hash is safe."""
    return (
        df.select(name, *natural_key)
        .distinct()
        .groupBy(name)
        .agg(F.count("*").alias("natural_keys"))
        .filter("natural_keys > 1")
    )

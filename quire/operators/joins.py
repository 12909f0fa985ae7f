"""Joins of large tables with dimensions and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 5_000_000
SPLITTABLE = ("inner", "left", "left_semi", "left_anti")


def planned_size(df: DataFrame) -> int:
    """Catalyst's size estimate of a DataFrame in bytes; huge when it knows nothing of the source."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    """The session's broadcast threshold in bytes; negative when broadcasting is off."""
    return df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def join_dimension(
    fact: DataFrame,
    dimension: DataFrame,
    on: list[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    limit: int | None = None,
) -> DataFrame:
    """Join a fact with a dimension on equal key names, safe for a fact key that holds a third of the rows.

    A dimension estimated under the broadcast threshold is broadcast by Catalyst and the fact is not
    shuffled. Beyond it the fact's rows are counted by key, reading the key alone. A key with more than
    `hot_rows` rows is split into as many parts as it needs and only its dimension rows are repeated;
    adaptive execution still broadcasts a dimension that turns out small. The input partition is part of
    the salt, which spreads identical rows and stays the same in a retried task.
    """
    if how not in SPLITTABLE:
        raise ValueError(f"{how} cannot be split on the fact side")
    size_limit = broadcast_limit(fact) if limit is None else limit
    if planned_size(dimension) <= size_limit:
        return fact.join(dimension, on, how)
    counted = fact.groupBy(*[F.col(c).alias(f"_h_{c}") for c in on]).agg(F.count("*").alias("_rows"))
    # At most one row for every `hot_rows` rows of the fact.
    hot = F.broadcast(counted.filter(F.col("_rows") > hot_rows).withColumn("_parts", F.ceil(F.col("_rows") / hot_rows).cast("int")))
    same = None
    for c in on:
        equal = F.col(c).eqNullSafe(F.col(f"_h_{c}"))
        same = equal if same is None else same & equal
    parts = F.coalesce("_parts", F.lit(1))
    spread = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in fact.columns])
    salted = fact.withColumn("_spread", spread).join(hot, same, "left")
    salted = salted.select(*fact.columns, F.pmod("_spread", parts).cast("int").alias("_salt"))
    numbers = F.explode(F.sequence(F.lit(0), parts - 1)).alias("_salt")
    copies = dimension.join(hot, same, "left").select(*dimension.columns, numbers)
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def orphan_keys(child: DataFrame, parent: DataFrame, on: str, parent_key: str | None = None) -> DataFrame:
    """Keys of `child` without a parent, with their row count; a NULL key is an orphan too.

    The child is counted per key first, so only one row per key reaches the join.
    """
    counted = child.groupBy(on).agg(F.count("*").alias("orphan_rows"))
    known = parent.select(F.col(parent_key or on).alias(on))
    return counted.join(known, on, "left_anti")


def resolve_code(
    df: DataFrame,
    lookup: DataFrame,
    code: str,
    label: str,
    lookup_code: str = "code",
    lookup_label: str = "libelle",
    otherwise: str = "Inconnu",
) -> DataFrame:
    """Add the label of a code from a lookup table; an unknown code keeps its row and gets `otherwise`."""
    labels = lookup.select(F.col(lookup_code).alias(code), F.col(lookup_label).alias("_label"))
    joined = join_dimension(df, labels, [code], "left")
    found = F.coalesce("_label", F.lit(otherwise)).alias(label)
    return joined.select(*[F.col(c) for c in df.columns], found)

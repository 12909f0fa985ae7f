"""Bringing batches and snapshots together without a table format that merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_evolved(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name; a column that one side lacks is NULL there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], newest_by: tuple[str, ...]) -> DataFrame:
    """The target with the batch applied: per key the newest row, on equal marks the batch's.

    The target has a row per key, as upserts leave it. Rows whose key the batch does not name pass as they
    are: with a batch small enough to broadcast the target is filtered where it lies, and only the rows
    that the batch touches meet it in a shuffle. A NULL key is a key. Rows that are equal in key, marks
    and side are ordered by all columns, so reruns agree.
    """
    names = batch.select(*[F.col(k).alias(f"_b_{k}") for k in keys]).distinct()
    same = None
    for k in keys:
        equal = F.col(k).eqNullSafe(F.col(f"_b_{k}"))
        same = equal if same is None else same & equal
    untouched = target.join(names, same, "left_anti")
    touched = target.join(names, same, "left_semi")
    both = union_evolved(
        touched.withColumn("_from_batch", F.lit(0)), batch.withColumn("_from_batch", F.lit(1))
    )
    rest = [c for c in both.columns if c not in (*keys, *newest_by, "_from_batch")]
    order = [F.col(c).desc_nulls_last() for c in (*newest_by, "_from_batch", *rest)]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    winners = both.withColumn("_place", place).filter("_place = 1").drop("_place", "_from_batch")
    return union_evolved(untouched, winners)


def replace_by_key(target: DataFrame, batch: DataFrame, keys: list[str], named: DataFrame | None = None) -> DataFrame:
    """The target without the rows whose key the batch has, and all rows of the batch; a NULL key is a key.

    named: the batch's keys, where they can be had for less than the batch.
    """
    names = (batch if named is None else named).select(*[F.col(k).alias(f"_b_{k}") for k in keys]).distinct()
    same = None
    for k in keys:
        equal = F.col(k).eqNullSafe(F.col(f"_b_{k}"))
        same = equal if same is None else same & equal
    return target.join(names, same, "left_anti").unionByName(batch)


LOW_HALF = 0xFFFFFFFF


def _fingerprint(columns: list[str], salt: int) -> Column:
    # The hash passes over NULLs, so their places are hashed as well.
    parts = [p for c in columns for p in (F.col(c), F.col(c).isNull())]
    return F.xxhash64(F.lit(salt), *parts)


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Each key with its change between two full snapshots: inserted, updated, deleted or unchanged.

    Both sides are reduced to keys and a 128-bit fingerprint of the other columns (NULLs included), so
    wide rows never travel; one aggregate with map-side partials compares them. Repeated keys are
    compared as bags: equal bags sum to zero when the new side counts negative. The halves are summed
    apart because whole 64-bit hashes would overflow. A column that one side lacks is NULL there.
    """
    columns = [c for c in dict.fromkeys([*old.columns, *new.columns]) if c not in keys]
    kinds = {**{f.name: f.dataType for f in new.schema}, **{f.name: f.dataType for f in old.schema}}

    def reduced(df: DataFrame, sign: int) -> DataFrame:
        missing = {c: F.lit(None).cast(kinds[c]) for c in columns if c not in df.columns}
        df = df.withColumns(missing) if missing else df
        a, b = _fingerprint(columns, 1), _fingerprint(columns, 2)
        return df.select(
            *keys,
            F.lit(sign).cast("bigint").alias("_sign"),
            a.alias("_a"),
            b.alias("_b"),
        )

    both = reduced(old, 1).unionByName(reduced(new, -1))
    sign = F.col("_sign")
    halves = {
        f"_{h}_{part}": F.sum(sign * value)
        for h in ("a", "b")
        for part, value in (
            ("high", F.shiftright(f"_{h}", 32)),
            ("low", F.col(f"_{h}").bitwiseAND(F.lit(LOW_HALF).cast("bigint"))),
        )
    }
    counted = both.groupBy(*keys).agg(
        F.count_if(sign == 1).alias("_old_rows"),
        F.count_if(sign == -1).alias("_new_rows"),
        *[total.alias(name) for name, total in halves.items()],
    )
    same = F.col("_old_rows") == F.col("_new_rows")
    for name in halves:
        same = same & (F.col(name) == 0)
    change = (
        F.when(F.col("_old_rows") == 0, "inserted")
        .when(F.col("_new_rows") == 0, "deleted")
        .when(same, "unchanged")
        .otherwise("updated")
    )
    return counted.select(*keys, change.alias("change"))

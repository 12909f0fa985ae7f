"""Where two large tables differ: sums of fingerprints over ranges of a key, finer and finer, and only then rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.merge import snapshot_diff

FANOUT, LEVELS = 64, 3
# With more unlike ranges than this they are not cut further; there are at most FANOUT ** LEVELS.
MOST_RANGES = 2048
# Bounds that reach the scan as literals; within them a broadcast table of range numbers tells the unlike ranges apart.
MOST_BOUNDS = 32


def _sums(df: DataFrame, range_of: Column, columns: list[str]) -> DataFrame:
    """Rows and two sums of row hashes by range; the sums of halves cannot overflow below 2 ** 31 rows."""
    parts = [p for c in columns for p in (F.col(c), F.col(c).isNull())]
    sums = []
    for salt in (1, 2):
        mark = F.xxhash64(F.lit(salt), *parts)
        sums += [F.sum(F.shiftright(mark, 32)).alias(f"_h{salt}"), F.sum(mark.bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))).alias(f"_l{salt}")]
    return df.groupBy(range_of.alias("_range")).agg(F.count("*").alias("_rows"), *sums)


def _unlike(old: DataFrame, new: DataFrame, range_of: Column, columns: list[str]) -> list[int]:
    """Numbers of the ranges whose rows differ: one row per range and side meets in the join."""
    a, b = _sums(old, range_of, columns), _sums(new, range_of, columns)
    names = [c for c in a.columns if c != "_range"]
    b = b.select("_range", *[F.col(c).alias(f"_b{c}") for c in names])
    same = F.lit(True)
    for c in names:
        same = same & F.col(c).eqNullSafe(F.col(f"_b{c}"))
    return sorted(row[0] for row in a.join(b, "_range", "full").where(~same).select("_range").collect())


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    found: list[list[int]] = []
    for low, high in sorted(ranges):
        if found and low <= found[-1][1]:
            found[-1][1] = max(high, found[-1][1])
        else:
            found.append([low, high])
    return [(low, high) for low, high in found]


def unlike_ranges(old: DataFrame, new: DataFrame, key: str, levels: int = LEVELS, fanout: int = FANOUT) -> list[tuple[int, int]]:
    """Ranges [low, high) of a whole-number key in which the tables differ; empty if they are alike.

    Each level cuts the unlike ranges of the level before by `fanout`, and reads the rows of these ranges only. Nothing but a row per
    range leaves a task.
    """
    return _unlike_ranges(old, new, key, levels, fanout)[0]


def _unlike_ranges(old: DataFrame, new: DataFrame, key: str, levels: int, fanout: int) -> tuple[list[tuple[int, int]], int]:
    """The ranges, and the width of which they are whole multiples, counted from the first one's lower end."""
    columns = sorted(set(old.columns) | set(new.columns))
    if set(old.columns) != set(new.columns):
        raise ValueError(f"columns differ: {sorted(set(old.columns) ^ set(new.columns))}")
    edges = [df.agg(F.min(key), F.max(key)).first() for df in (old, new)]
    known = [v for row in edges for v in row if v is not None]
    if not known:
        return [], 1
    low, high = min(known), max(known) + 1
    ranges, width = [(low, high)], high - low
    for _ in range(levels):
        inner = -(-width // fanout)
        numbers = _unlike(_inside(old, key, ranges, width), _inside(new, key, ranges, width), _number(key, low, inner), columns)
        ranges, width = _merged([(low + n * inner, low + (n + 1) * inner) for n in numbers]), inner
        if not ranges or len(ranges) > MOST_RANGES or width == 1:
            break
    return ranges, width


def _number(key: str, low: int, width: int) -> Column:
    return F.call_function("div", F.col(key) - F.lit(low), F.lit(width).cast("bigint"))


def _covering(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """At most MOST_BOUNDS ranges that hold all of these: the widest gaps stay open."""
    gaps = sorted(range(1, len(ranges)), key=lambda i: ranges[i - 1][1] - ranges[i][0])[: MOST_BOUNDS - 1]
    starts = [0, *sorted(gaps)]
    return [(ranges[a][0], ranges[b - 1][1]) for a, b in zip(starts, [*starts[1:], len(ranges)])]


def _inside(df: DataFrame, key: str, ranges: list[tuple[int, int]], width: int) -> DataFrame:
    """The rows of these ranges, which are whole multiples of `width` apart. The plan is the same however many ranges there are."""
    if not ranges:
        return df.where(F.lit(False))
    near = F.lit(False)
    for low, high in _covering(ranges):
        near = near | ((F.col(key) >= low) & (F.col(key) < high))
    held = df.where(near)
    if len(ranges) <= MOST_BOUNDS:
        return held
    base = ranges[0][0]
    runs = [((low - base) // width, (high - base) // width - 1) for low, high in ranges]
    numbers = df.sparkSession.createDataFrame(runs, "first bigint, last bigint").select(F.explode(F.sequence("first", "last")).alias("_range"))
    # At most FANOUT ** LEVELS numbers.
    return held.join(F.broadcast(numbers), _number(key, base, width) == F.col("_range"), "left_semi")


def drill_down(old: DataFrame, new: DataFrame, key: str, levels: int = LEVELS, fanout: int = FANOUT) -> DataFrame:
    """(key, change) of the rows that differ: inserted, updated or deleted. Rows without a key are compared in any case.

    Only rows in unlike ranges are shuffled.
    """
    ranges, width = _unlike_ranges(old, new, key, levels, fanout)
    sides = [_inside(df, key, ranges, width).unionByName(df.where(F.col(key).isNull())) for df in (old, new)]
    return snapshot_diff(*sides, [key]).where("change <> 'unchanged'")

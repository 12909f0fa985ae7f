"""Mixing sources to target weights by temperature.

A source's share of all tokens is raised to an exponent between 0 (all alike) and 1 (as found) and normalised. The exponent is
bisected until the weights' entropy meets the target, or until no source is repeated more often than allowed, whichever leaves
the shares closer to those found. Each source then gets its part of the budget: whole epochs, and of one more epoch the first
documents, up to the budget. A source's documents are dealt into blocks once; each epoch permutes the blocks anew, and
the documents of each block. `order` gives every copy its epoch, block and place, `mix` only the copies: a
document is in the part epoch if its place is not beyond the source's threshold, so `mix` neither shuffles nor gathers texts.

Tokens are white-space separated words. A null source is a source of its own. A source without tokens has weight 0 and its
documents are read once. Rows with equal doc_id in a source go together. Null doc_ids have a place like any other. Null and
empty texts have no tokens, texts may be of any length. An empty table stays empty. Other columns, whatever their names, are kept by
`mix` and ignored by `plan` and `order`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import stored

LEVELS, ROUNDS = 5, 5
MOST_REPEATS = 4.0
SEED = 17
# Tokens of a block: a ten-thousandth of all, but within these bounds, so that one task can put a block in order.
BLOCKS, LEAST_BLOCK, MOST_BLOCK = 10_000, 10_000, 1 << 20


def tokens_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _key(source: str) -> Column:
    return F.when(F.col(source).isNull(), "n").otherwise(F.concat(F.lit("s"), F.col(source).cast("string")))


def temperature(sources: DataFrame, target_entropy: float | None = None, most_repeats: float = MOST_REPEATS, budget: int | None = None) -> tuple[float, float]:
    """(exponent, budget) for sources (key, tokens); see `plan` for the parameters.

    Each job evaluates all points that the next five bisections could ask for; only sums over sources come to the driver.
    """
    sources = sources.where("tokens > 0")
    total, most, least, n = sources.agg(F.sum("tokens"), F.max("tokens"), F.min("tokens"), F.count("*")).first()
    if not n:
        return 1.0, 0.0
    share = F.col("tokens") / F.lit(float(total))

    def measured(points: list[float]) -> list[tuple[float, float, float]]:
        """Entropy, most and fewest readings of a source at each exponent."""
        sums = [x for p in points for x in (F.sum(F.pow(share, F.lit(p))), F.sum(F.pow(share, F.lit(p)) * F.log(share)))]
        row, found = sources.agg(*[x.alias(f"s{i}") for i, x in enumerate(sums)]).first(), []
        for at, p in enumerate(points):
            z, zl = row[2 * at], row[2 * at + 1]
            ends = [(tokens / total) ** (p - 1) / z for tokens in (least, most)]
            scale = budget / total if budget is not None else 1 / min(ends)
            found.append((math.log(z) - p * zl / z, max(ends) * scale, min(ends) * scale))
        return found

    natural = measured([1.0])[0][0]
    goal = (natural + math.log(n)) / 2 if target_entropy is None else target_entropy
    # Between low, where a condition fails, and high, where it holds or the shares are as found.
    low, high = 0.0, 1.0
    fits = lambda seen: seen[0] <= goal + 1e-12 and seen[1] <= most_repeats
    if fits(measured([0.0])[0]):
        high = 0.0
    for _ in range(ROUNDS if high else 0):
        points = [low + (high - low) * i / 2**LEVELS for i in range(1, 2**LEVELS)]
        good = [p for p, seen in zip(points, measured(points)) if fits(seen)]
        step = (high - low) / 2**LEVELS
        high = min(good, default=high)
        low = high - step
    z = sources.agg(F.sum(F.pow(share, F.lit(high)))).first()[0]
    spent = float(budget) if budget is not None else total * z * (most / total) ** (1 - high)
    return high, spent


def plan(docs: DataFrame, target_entropy: float | None = None, most_repeats: float = MOST_REPEATS, budget: int | None = None, seed: int = SEED) -> DataFrame:
    """Per source: key, tokens, weight, epochs and the threshold (last_block, last_place) of the part epoch.

    target_entropy: in nats; None is halfway from the shares found to equal ones. budget: tokens to deal out; None is the
    smallest with which every document is read at least once.
    """
    rows = stored(docs.select("doc_id", _key("source").alias("key"), tokens_of().alias("tokens")), "mixing-tokens")
    sources = stored(rows.groupBy("key").agg(F.sum("tokens").alias("tokens")), "mixing-sources")
    exponent, spent = temperature(sources, target_entropy, most_repeats, budget)
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    raised = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(max(total, 1))), F.lit(exponent))).otherwise(0.0)
    z = sources.agg(F.sum(raised)).first()[0] or 1.0
    block = min(max(LEAST_BLOCK, total // BLOCKS), MOST_BLOCK)
    dealt = (
        sources.withColumn("weight", raised / F.lit(z))
        .withColumn("dealt", F.round(F.col("weight") * F.lit(spent)).cast("long"))
        .withColumn("epochs", F.when(F.col("tokens") > 0, F.expr("dealt div tokens")).otherwise(1))
        .withColumn("rest", F.when(F.col("tokens") > 0, F.col("dealt") - F.col("epochs") * F.col("tokens")).otherwise(0))
        .withColumn("blocks", F.ceil(F.col("tokens") / F.lit(block)).cast("long"))
        .withColumn("blocks", F.greatest(F.col("blocks"), F.lit(1)))
    )
    placed = rows.join(dealt.select("key", "blocks", "epochs", "rest"), "key").select("key", "tokens", "rest", *_places(seed))
    by_block = placed.groupBy("key", "rest", "block").agg(F.sum("tokens").alias("tokens"))
    ordered = Window.partitionBy("key").orderBy("block")
    # A row for each block goes through these windows, ordered by the hash that permutes them.
    ends = by_block.withColumn("end", F.sum("tokens").over(ordered))
    cut = stored(ends.where("end > rest").groupBy("key").agg(F.min_by("block", "end").alias("cut"), F.min("end").alias("cut_end")), "mixing-cuts")
    # Blocks of equal hash would be one; only the one block of each source in which the budget ends is ordered by document.
    here = (placed["key"] == cut["key"]) & (placed["block"] == cut["cut"])
    last = placed.join(cut, here).select(placed["key"], "place", "tokens", "rest", "cut", "cut_end")
    sizes = last.groupBy("key").agg(F.sum("tokens").alias("in_block"))
    peers = Window.partitionBy("key").orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = last.withColumn("run", F.sum("tokens").over(peers)).join(sizes, "key").where(F.col("cut_end") - F.col("in_block") + F.col("run") <= F.col("rest"))
    edge = inside.groupBy("key").agg(F.max("place").alias("last_place"))
    return stored(dealt.join(cut.select("key", "cut"), "key", "left").join(edge, "key", "left").select(
        "key", "tokens", "weight", "dealt", "epochs", "rest", "blocks", F.col("cut").alias("last_block"), "last_place"
    ), "mixing-plan")


def _home(seed: int, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), blocks)


def _block_rank(seed: int, key: Column, epoch: Column, home: Column) -> Column:
    return F.xxhash64(F.lit(seed + 1), key, epoch, home)


def _place_rank(seed: int, epoch: Column) -> Column:
    return F.xxhash64(F.lit(seed + 2), epoch, F.col("doc_id"))


def _places(seed: int) -> tuple[Column, Column]:
    """A document's block in the part epoch, named by the hash that permutes the blocks, and its place in the block."""
    epoch = F.col("epochs")
    return _block_rank(seed, F.col("key"), epoch, _home(seed, F.col("blocks"))).alias("block"), _place_rank(seed, epoch).alias("place")


def copies(docs: DataFrame, sources: DataFrame, seed: int = SEED, prefix: str = "mix_") -> DataFrame:
    """docs with mix_key, mix_weight and mix_copies: how often each is read. sources: what `plan` returned."""
    names = {name: f"{prefix}{name}" for name in ("key", "weight", "epochs", "blocks", "rest", "last_block", "last_place")}
    key, epochs, blocks = (F.col(names[n]) for n in ("key", "epochs", "blocks"))
    # One row per source: Spark broadcasts it if it is small and splits a hot source if it is not.
    joined = docs.withColumn(names["key"], _key("source")).join(sources.select(*[F.col(a).alias(b) for a, b in names.items()]), names["key"])
    block, place = _block_rank(seed, key, epochs, _home(seed, blocks)), _place_rank(seed, epochs)
    cut, last = F.col(names["last_block"]), F.col(names["last_place"])
    more = (F.col(names["rest"]) > 0) & (cut.isNull() | (block < cut) | ((block == cut) & (place <= last)))
    return joined.withColumn(f"{prefix}copies", (epochs + F.coalesce(more, F.lit(False)).cast("long"))).select(
        *docs.columns, *(f"{prefix}{name}" for name in ("key", "weight", "copies"))
    )


def order(docs: DataFrame, sources: DataFrame, seed: int = SEED) -> DataFrame:
    """Every copy of every document: doc_id, source, weight, copies, and its epoch (from 1), block and place in it (from 0).

    In the order of epoch, block and place each source is read in permuted blocks, and the part epoch ends with the budget. A
    document that is not read has one row without epoch. Only ids, sources and token counts are shuffled; a task orders a block at a time.
    """
    own = docs.select(F.col("doc_id"), "source", "text")
    counted = copies(own, sources, seed).join(sources.select(F.col("key").alias("mix_key"), F.col("blocks").alias("mix_blocks")), "mix_key")
    rows = counted.select(
        "doc_id", "source", F.col("mix_key").alias("key"), F.col("mix_weight").alias("weight"), F.col("mix_copies").alias("copies"),
        _home(seed, F.col("mix_blocks")).alias("home"), F.xxhash64("text").alias("mark"),
    )
    rows = stored(rows, "mixing-copies")
    each = rows.withColumn("at", F.explode_outer(F.when(F.col("copies") > 0, F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))))
    # A row for each block and epoch.
    read = each.where("at is not null").groupBy("key", "at", "home").agg(F.count("*").alias("n")).drop("n")
    by_rank = Window.partitionBy("key", "at").orderBy("rank", "home")
    ranked = read.withColumn("rank", _block_rank(seed, F.col("key"), F.col("at"), F.col("home")))
    ranked = ranked.select("key", "at", "home", (F.row_number().over(by_rank) - 1).cast("long").alias("block"))
    in_block = Window.partitionBy("key", "at", "home").orderBy("rank", "doc_id", "mark")
    placed = each.withColumn("rank", _place_rank(seed, F.col("at"))).withColumn("place", (F.row_number().over(in_block) - 1).cast("long"))
    return placed.join(ranked, ["key", "at", "home"], "left").select(
        "doc_id", "source", "weight", "copies", (F.col("at") + 1).alias("epoch"), "block", F.when(F.col("at").isNotNull(), F.col("place")).alias("place")
    )


def mix(docs: DataFrame, **options: float) -> DataFrame:
    """docs, each row as often as the mixture reads it."""
    seed, prefix = options.get("seed", SEED), "mix_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    counted = copies(docs, plan(docs, **options), seed, prefix)
    times = F.sequence(F.lit(1).cast("long"), F.col(f"{prefix}copies"))
    return counted.where(F.col(f"{prefix}copies") > 0).withColumn(f"{prefix}epoch", F.explode(times)).select(docs.columns)

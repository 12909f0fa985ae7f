"""Toxicity scores: boosted trees over dense features of a text, calibrated by isotonic regression.

The model learns from a bounded, stratified sample of labelled rows: at most `per_class` of each label, chosen by a hash of
the doc_id. Every fifth row by crc32(doc_id) is held out and never learned from. The lexicon (words and word beginnings that
mark toxic texts) comes from the same sample; label, language, source and doc_id are no features.

Null and empty texts have all-zero features and get the score of such a row. A doc_id with several labels counts as toxic if
one of them says so; null labels and null doc_ids are not learned from. Without labels of both kinds every score is the share of
toxic ones among the labels seen, or 0. Repeated rows get a row each. Other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import WORD, stored, utf8

PER_CLASS = 4000
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 1
STEMS = range(3, 9)
LEXICON_ROWS = 400
SURE = 30.0
NEAR = 5
LIMIT = 0.5
RANGE = 1 << 31
# Words of address in the languages of the corpus.
ADDRESS = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch sie ihnen tu te toi ton ta tes vous votre tú ti usted ustedes vosotros".split())
# Digits and signs written for letters.
LOOKALIKE = str.maketrans("0134578@$!*", "oleastbasia")
FEATURES = ("words", "hits", "density", "weight", "weight_density", "strongest", "kinds", "addressed", "address_rate", "capitals", "shouting", "exclaims", "repeats", "punctuation", "masked", "masked_hits")

_words = re.compile(WORD)
_shout = re.compile(rb"\b[A-Z]{3,}\b")
_repeat = re.compile(rb"[!?]{2,}")
_digit = re.compile(r"[0-9@$!*][a-z]")
_masked = re.compile(r"(?<!\S)[a-z]+[0-9@$!*]+[a-z]+(?!\S)")
_not_capital = bytes(range(65, 91))
_signs = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def fold() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))


def _grams(word: str) -> Iterator[str]:
    yield "=" + word
    for size in STEMS:
        if len(word) >= size:
            yield word[:size]


def _heads(lexicon: dict[str, float]) -> frozenset[str]:
    return frozenset(gram.lstrip("=")[: STEMS[0]] for gram in lexicon)


def features(text: str | None, lexicon: dict[str, float], heads: frozenset[str] | None = None) -> list[float]:
    """The values of FEATURES, rates per word or per character; heads are the first letters of the lexicon's entries."""
    raw = utf8(text)
    if not raw:
        return [0.0] * len(FEATURES)
    low = raw.lower().decode("utf-8", "replace")
    words = _words.findall(low)
    heads = _heads(lexicon) if heads is None else heads
    hits, kinds = [], set()
    for at in [at for at, word in enumerate(words) if word[: STEMS[0]] in heads]:
        if found := [(lexicon[gram], gram) for gram in _grams(words[at]) if gram in lexicon]:
            weight, gram = max(found)
            hits.append((at, weight))
            kinds.add(gram)
    addressed = [at for at, word in enumerate(words) if word in ADDRESS]
    close = 0
    if hits and addressed:
        where = np.array(addressed)
        close = sum(bool(np.abs(where - at).min() <= NEAR) for at, _ in hits)
    masked = _masked.findall(low) if _digit.search(low) else []
    unmasked = [w for w in (m.translate(LOOKALIKE) for m in masked) if any(g in lexicon for g in _grams(w))]
    n, size = max(1, len(words)), len(raw)
    weight = sum(w for _, w in hits)
    return [
        float(np.log1p(len(words))), float(len(hits)), len(hits) / n, weight, weight / n, max((w for _, w in hits), default=0.0), float(len(kinds)),
        float(close), len(addressed) / n, (size - len(raw.translate(None, _not_capital))) / size, len(_shout.findall(raw)) / n,
        raw.count(b"!") / n, len(_repeat.findall(raw)) / n, (size - len(raw.translate(None, _signs))) / size, len(masked) / n, float(len(unmasked)),
    ]


def with_features(docs: DataFrame, lexicon: dict[str, float], text: str = "text", keep_text: bool = False) -> DataFrame:
    """The frame's columns, the text only if asked for, and a column `features`."""
    kept = [name for name in docs.columns if keep_text or name != text]
    schema = docs.select(*kept).withColumn("features", F.array(F.lit(0.0))).schema

    heads, at = _heads(lexicon), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(text, lexicon, heads) for text in batch.column(at).to_pylist()]
            values = pa.array(rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in kept), values], [*kept, "features"])

    return docs.mapInArrow(run, schema)


def sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, text, toxic, weight, part) of at most 2 * per_class labelled rows; weight restores the share of a label."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
        .withColumn("part", fold().cast("int")).where(F.col("part") != HELD_OUT)
    )
    known = stored(known, "toxicity-labels")
    totals = {row.toxic: row.total for row in known.groupBy("toxic").agg(F.count("*").alias("total")).collect()}
    # A part of the hash range that holds about a quarter more than is wanted, so that few rows are ordered.
    place, reach = F.pmod(F.xxhash64("doc_id"), F.lit(RANGE)), {t: min(1.0, (1.25 * per_class + 50) / n) for t, n in totals.items()}
    value = lambda values: reduce(lambda rest, t: F.when(F.col("toxic") == t, F.lit(values[t])).otherwise(rest), values, F.lit(None))
    near = known.withColumn("place", place).where(F.col("place") < value({t: int(share * RANGE) for t, share in reach.items()}))
    order = Window.partitionBy("toxic").orderBy("place", "doc_id")
    chosen = near.withColumn("row", F.row_number().over(order)).where(F.col("row") <= per_class)
    chosen = chosen.withColumn("weight", value({t: max(1.0, n / per_class) for t, n in totals.items()}).cast("double"))
    # At most 2 * per_class short rows.
    chosen = F.broadcast(chosen.select("doc_id", "toxic", "weight", "part"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen, "doc_id")


def lexicon_of(rows: DataFrame, size: int = LEXICON_ROWS, sure: float = SURE) -> dict[str, float]:
    """Words and beginnings of words that mark toxic texts, with their log odds: the `size` with the largest likelihood ratio."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                words = set(_words.findall(utf8(text).lower().decode("utf-8", "replace")))
                found[int(toxic > 0)].update({gram for word in words for gram in _grams(word)})
        # Every gram goes: what no toxic text of this task holds lowers a mark found elsewhere. The rows are a bounded sample.
        grams = list(found[0].keys() | found[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(grams, pa.string()), pa.array([found[1][g] for g in grams], pa.int64()), pa.array([found[0][g] for g in grams], pa.int64())],
            ["gram", "toxic", "clean"],
        )

    both = {int(r.toxic > 0): r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = both.get(1, 0), both.get(0, 0)
    if not n1 or not n0:
        return {}
    sums = rows.select("text", "toxic").mapInArrow(count, "gram string, toxic long, clean long").groupBy("gram").agg(
        F.sum("toxic").alias("a"), F.sum("clean").alias("b")
    ).where("a > 0")
    share = n1 / (n1 + n0)
    a, b = F.col("a"), F.col("b")
    part = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    ratio = 2 * (part(a, (a + b) * share) + part(b, (a + b) * (1 - share)))
    odds = F.log((a + 0.5) / (n1 + 1)) - F.log((b + 0.5) / (n0 + 1))
    best = sums.withColumn("ratio", ratio).withColumn("odds", odds).where("odds > 1").orderBy(F.desc("ratio"), "gram").limit(size).collect()
    least = min(sure, best[0].ratio / 2) if best else 0.0
    return {row.gram: row.odds for row in best if row.ratio >= least}


@dataclass
class Scorer:
    """What training leaves: a lexicon, trees and a calibration; `prior` stands in where nothing could be learned."""

    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    prior: float = 0.0

    def score(self, docs: DataFrame) -> DataFrame:
        """(doc_id, score) of every row."""
        rows = with_features(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), self.lexicon)
        return self._scored(rows).select("doc_id", "score")

    def below(self, docs: DataFrame, limit: float) -> DataFrame:
        """The rows of docs with a lower score; scores travel with their rows, so nothing is shuffled."""
        renamed = docs.select(*[F.col(name).alias(f"row_{name}") for name in docs.columns])
        scored = self._scored(with_features(renamed, self.lexicon, "row_text", keep_text=True))
        return scored.where(F.col("score") < limit).select(*[F.col(f"row_{name}").alias(name) for name in docs.columns])

    def _scored(self, rows: DataFrame) -> DataFrame:
        if self.trees is None:
            return rows.withColumn("score", F.lit(self.prior))
        marked = self._raw(rows.withColumn("features", array_to_vector("features")))
        if self.calibration is not None:
            marked = self.calibration.setFeaturesCol("margin").setPredictionCol("score").transform(marked)
        else:
            marked = marked.withColumn("score", F.col("margin"))
        return marked.withColumn("score", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("score"))))

    def _raw(self, rows: DataFrame) -> DataFrame:
        return self.trees.transform(rows).withColumn("margin", vector_to_array("probability")[1])


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, rounds: int = 16, depth: int = 4) -> Scorer:
    """Fit lexicon and trees on the learning rows of the sample and the calibration on one fold that the trees do not see."""
    rows = stored(sample(docs, labels, per_class), "toxicity-sample")
    seen = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.sum("weight").alias("n")).collect()}
    if len(seen) < 2:
        return Scorer({}, None, None, float(max(seen, default=0)))
    learned = rows.where(F.col("part") != CALIBRATION)
    lexicon = lexicon_of(learned)
    table = stored(with_features(rows.select("text", "toxic", "weight", "part"), lexicon).withColumn("label", F.col("toxic").cast("double")), "toxicity-features")
    vectors = table.withColumn("features", array_to_vector("features")).repartition(4)
    fit, rest = vectors.where(F.col("part") != CALIBRATION), vectors.where(F.col("part") == CALIBRATION)
    if fit.select("label").distinct().count() < 2:
        return Scorer(lexicon, None, None, seen[1] / sum(seen.values()))
    trees = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=1, weightCol="weight", minInstancesPerNode=2).fit(fit)
    scorer = Scorer(lexicon, trees, None)
    if rest.select("label").distinct().count() == 2:
        margins = scorer._raw(rest).select("label", "weight", "margin")
        scorer.calibration = IsotonicRegression(featuresCol="margin", weightCol="weight").fit(margins)
    return scorer


def toxicity(docs: DataFrame, labels: DataFrame, **options: int) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    scored = train(docs, labels, **options).score(docs)
    held = F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held, "score", (F.col("score") >= LIMIT).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, **options: int) -> DataFrame:
    """The documents that are not predicted toxic."""
    return train(docs, labels, **options).below(docs, LIMIT)

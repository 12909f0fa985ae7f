"""Delimited files whose every line is accounted for: accepted, or set aside with its reason to be looked at."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.model.fields import SourceTable
from quire.plans.gate import FAIL, PASS, counted, entry, percent, report
from quire.session import scratch_folder
from quire.sources.delimited import CORRUPT, read_delimited

FILE = "_file"


@dataclass(frozen=True)
class Intake:
    """accepted: rows with the table's columns; rejected: (_file, _corrupt_record); lines: (_file, lines, accepted, rejected, balanced)."""

    accepted: DataFrame
    rejected: DataFrame
    lines: DataFrame

    def check(self, name: str, limit: float = 0.0) -> DataFrame:
        """A row of the gate's report: FAIL beyond the limit, in percent, or if lines are missing."""
        sums = self.lines.agg(
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("lines", "accepted", "rejected")],
            F.count_if(~F.col("balanced")).alias("unbalanced"),
        )
        rate = percent(F.col("rejected"), F.col("lines"))
        status = F.when((F.col("unbalanced") > 0) | (rate > limit), FAIL).otherwise(PASS)
        detail = counted(*[(c, F.col(c)) for c in ("lines", "accepted", "rejected")], ("files not balanced", F.col("unbalanced")))
        return report(sums, entry(f"rejected lines {name}", status, rate, limit, detail))


def take_in(spark: SparkSession, path: str, table: SourceTable, encoding: str = "UTF-8") -> Intake:
    """Read files with the table's schema. A line that does not fit is set aside as it stands; no line is lost.

    The files are parsed once and stored. Lines are then counted from the files as text, by another way than the parser's: all but
    each file's header and blank lines.
    """
    parsed = read_delimited(spark, path, table.schema, encoding, keep_corrupt=True).withColumn(FILE, F.col("_metadata.file_path"))
    folder = scratch_folder(spark, f"intake-{table.name}")
    parsed.write.parquet(folder)
    stored = spark.read.schema(parsed.schema).parquet(folder)
    bad = F.col(CORRUPT).isNotNull()
    taken = stored.groupBy(FILE).agg(F.count_if(~bad).alias("accepted"), F.count_if(bad).alias("rejected"))
    text = spark.read.option("encoding", encoding).text(path).where(F.trim("value") != "")
    there = text.groupBy(F.col("_metadata.file_path").alias(FILE)).agg((F.count("*") - 1).alias("lines"))
    counts = there.join(taken, FILE, "left").select(
        FILE, "lines", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("accepted", "rejected")]
    )
    lines = counts.withColumn("balanced", F.col("lines") == F.col("accepted") + F.col("rejected"))
    return Intake(stored.where(~bad).select(table.source_columns), stored.where(bad).select(FILE, CORRUPT), lines)

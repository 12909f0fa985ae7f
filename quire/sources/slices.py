"""Extraction in slices that goes on where it stopped.

The slices are the values of some columns, such as year and publisher, found once and stored with the extract. A ledger names
the slices that are whole; a further run reads the missing ones only, several at a time, and at last the rows that no slice
names. A slice is replaced as a whole, so what a killed run has left half-written is written again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.columns import literal
from quire.sources.commits import Commits

TOGETHER = 32
REST = -1
SLICE = "_slice"


class SlicedExtract:
    """An extract under a folder: `plan`, `ledger` and `data`, one folder in `data` for each slice."""

    def __init__(self, spark: SparkSession, folder: str, columns: list[str]) -> None:
        self.spark, self.folder, self.columns = spark, folder.rstrip("/"), columns
        self._files = Commits(spark, folder)

    def _has(self, name: str) -> bool:
        # Written whole or not at all.
        return "_SUCCESS" in self._files._names(f"{self.folder}/{name}")

    def plan(self, source: DataFrame | None = None) -> DataFrame:
        """(_slice, columns): the slices' numbers; found from the source in the first run, which reads these columns only."""
        if not self._has("plan"):
            if source is None:
                raise ValueError("no plan is stored yet")
            # As many rows as there are slices.
            values = source.select(*self.columns).distinct().dropna().sort(*self.columns).collect()
            rows = [(number, *row) for number, row in enumerate(values)]
            kinds = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in self.columns)
            self.spark.createDataFrame(rows, f"{SLICE} int, {kinds}").coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/plan")
        return self.spark.read.parquet(f"{self.folder}/plan")

    def ledger(self) -> DataFrame:
        """(_slice, row_count) of the slices that are whole."""
        if self._files._names(f"{self.folder}/ledger"):
            return self.spark.read.schema(f"{SLICE} int, row_count bigint").parquet(f"{self.folder}/ledger")
        return self.spark.createDataFrame([], f"{SLICE} int, row_count bigint")

    def missing(self) -> list[int]:
        done = {row[SLICE] for row in self.ledger().select(SLICE).collect()}
        return [n for n in [*sorted(row[SLICE] for row in self.plan().select(SLICE).collect()), REST] if n not in done]

    def run(self, source: DataFrame, together: int = TOGETHER, groups: int | None = None) -> list[int]:
        """Read missing slices, `together` in one pass, all of them or `groups` passes; gives the slices read."""
        plan = self.plan(source)
        values = {row[SLICE]: row for row in plan.collect()}
        missing = self.missing()
        named = [n for n in missing if n != REST]
        passes = [named[i : i + together] for i in range(0, len(named), together)]
        passes += [[REST]] if missing else []
        read: list[int] = []
        for numbers in passes[:groups]:
            if numbers == [REST]:
                # The plan is as many rows as there are slices.
                rows = source.join(F.broadcast(plan), self.columns, "left_anti").withColumn(SLICE, F.lit(REST))
            else:
                own = plan.where(F.col(SLICE).isin(numbers))
                # Literals first, which the source can filter by; the join then tells the slices apart.
                chosen = source.where(self._may_be([values[n] for n in numbers], source))
                rows = chosen.join(F.broadcast(own), self.columns)
            self._write(rows.select(*source.columns, SLICE), numbers)
            read += numbers
        return read

    def _may_be(self, rows: list, source: DataFrame) -> Column:
        """Each column has a value of one of these slices: one list for each column, as a term for each slice outgrows the JVM's
        compile limit."""
        named = {c: [literal(value, source.schema[c].dataType) for value in dict.fromkeys(row[c] for row in rows)] for c in self.columns}
        return reduce(Column.__and__, [F.col(c).isin(values) for c, values in named.items()])

    def _write(self, rows: DataFrame, numbers: list[int]) -> None:
        data = f"{self.folder}/data"
        # A heavy slice is cut over as many tasks and files as its rows need, by their measured size: no sample reads the source before.
        rows.hint("rebalance", SLICE).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(SLICE).parquet(data)
        counts = {}
        if self._files._names(data):
            written = self.spark.read.schema(rows.schema).parquet(data).where(F.col(SLICE).isin(numbers))
            counts = {row[SLICE]: row.n for row in written.groupBy(SLICE).agg(F.count("*").alias("n")).collect()}
        entries = [(n, counts.get(n, 0)) for n in numbers]
        self.spark.createDataFrame(entries, f"{SLICE} int, row_count bigint").coalesce(1).write.mode("append").parquet(f"{self.folder}/ledger")

    def table(self, source: DataFrame) -> DataFrame:
        """What has been extracted, with the source's columns."""
        data = f"{self.folder}/data"
        if not self._files._names(data):
            return self.spark.createDataFrame([], source.schema)
        return self.spark.read.schema(source.schema).parquet(data).select(source.columns)

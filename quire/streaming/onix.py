"""Book metadata that arrives as XML files, merged into a table of products batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.operators.merge import replace_by_key
from quire.sources.commits import Commit, Commits
from quire.sources.xml import PRODUCT_SCHEMA

FILES_PER_BATCH = 1000
CORRUPT, FILE, CHANGED, PLACE = "_corrupt", "_file", "_changed", "_place"
PRODUCTS, QUARANTINE = "products", "quarantine"


def load_products(spark: SparkSession, folder: str, root: str, checkpoint: str, files_per_batch: int = FILES_PER_BATCH) -> None:
    """Take over all files not seen before, then stop. `root` and `checkpoint` are shared folders that stay between runs.

    A product replaces the one with its reference; of several in a batch the one from the newest file counts, then the file that
    is last by name, then the last in it. A file with a broken record, or with a product without a reference, is set aside
    whole: none of its products is merged. Table, quarantine and the number of the batch become visible with one commit, so a batch that is
    run again after a crash changes nothing.
    """
    arriving = (
        spark.readStream.format("xml")
        .option("rowTag", "Product")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxFilesPerTrigger", files_per_batch)
        .schema(f"{PRODUCT_SCHEMA}, {CORRUPT} string")
        .load(folder)
        .select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_modification_time").alias(CHANGED))
    )
    run = (
        arriving.writeStream.foreachBatch(lambda batch, number: merge_batch(batch, number, root))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()


def merge_batch(batch: DataFrame, number: int, root: str) -> None:
    """One batch into the table; nothing, if a batch with this number or a later one is in it."""
    spark = batch.sparkSession
    lake = Commits(spark, root)
    before = lake.latest()
    if number <= before.marks.get("batch", -1):
        return
    # Parsed once; the place in the file is its place in the task, as a file is read in order.
    folder = lake.new_folder("batch")
    batch.withColumn(PLACE, F.monotonically_increasing_id()).write.parquet(folder)
    rows = spark.read.parquet(folder)
    broken = rows.where(F.col(CORRUPT).isNotNull() | F.col("RecordReference").isNull())
    reasons = broken.groupBy(FILE).agg(
        F.count_if(F.col(CORRUPT).isNotNull()).alias("broken_records"),
        F.count_if(F.col(CORRUPT).isNull()).alias("without_reference"),
        F.first(F.substring(CORRUPT, 1, 200), ignorenulls=True).alias("begins"),
    )
    sound = rows.join(reasons.select(FILE), FILE, "left_anti")
    newest = Window.partitionBy("RecordReference").orderBy(F.desc(CHANGED), F.desc(FILE), F.desc(PLACE))
    fresh = sound.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank", CORRUPT, CHANGED, PLACE)
    fresh = fresh.withColumn("batch", F.lit(number).cast("bigint"))
    known = lake.read(before, PRODUCTS)
    tables = {}
    set_aside = reasons.withColumn("batch", F.lit(number).cast("bigint"))
    past = lake.read(before, QUARANTINE)
    for name, df in ((PRODUCTS, fresh if known is None else replace_by_key(known, fresh.select(known.columns), ["RecordReference"])),
                     (QUARANTINE, set_aside if past is None else past.unionByName(set_aside))):
        target = lake.new_folder(name)
        df.write.parquet(target)
        tables[name] = {"schema": df.schema.json(), "folders": {"": target}}
    lake.commit(Commit(before.version + 1, tables, {"batch": number}))


def products(spark: SparkSession, root: str) -> DataFrame | None:
    lake = Commits(spark, root)
    return lake.read(lake.latest(), PRODUCTS)


def quarantined(spark: SparkSession, root: str) -> DataFrame | None:
    """(_file, broken_records, without_reference, begins, batch) of files set aside."""
    lake = Commits(spark, root)
    return lake.read(lake.latest(), QUARANTINE)

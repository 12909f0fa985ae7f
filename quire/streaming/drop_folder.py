"""Delimited files dropped in a folder, loaded once each."""

from __future__ import annotations

from pyspark.sql import SparkSession

from quire.model.fields import SourceTable

FILES_PER_BATCH = 1000


def load_drop_folder(
    spark: SparkSession,
    folder: str,
    table: SourceTable,
    target: str,
    checkpoint: str,
    encoding: str = "UTF-8",
    files_per_batch: int = FILES_PER_BATCH,
) -> None:
    """Append all files not loaded before to a raw Parquet table, then stop.

    The checkpoint remembers the files, so a lost driver or executor repeats no file and skips none.
    `target` and `checkpoint` are shared folders that stay between runs.
    """
    arriving = (
        spark.readStream.schema(table.schema)
        .option("sep", "|")
        .option("header", True)
        .option("encoding", encoding)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )
    run = (
        arriving.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()

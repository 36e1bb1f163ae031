"""Intake of dropped files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.streaming.hourly import _exists


def ingest_drop(spark: SparkSession, folder: str, schema: str, target: str, checkpoint: str,
                header: bool = True, sep: str = ",") -> DataFrame:
    """Load every file of `folder` that was not loaded before, once, and return the whole target.

    The file source remembers what it has read in the checkpoint, which replaces waiting for a
    file: a run with nothing new does nothing. Each batch overwrites its own folder, so a batch
    repeated after a failure leaves no copies. Before the first file the target is an empty table.
    """
    stream = spark.readStream.schema(schema).csv(folder, header=header, sep=sep)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    query = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if not _exists(spark, target):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(target).drop("batch")

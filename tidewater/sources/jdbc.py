"""Options for database tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, key: str, low: int, high: int, rows_per_task: int = 1_000_000,
                 fetch_size: int = 10_000) -> dict[str, str]:
    """A parallel read cut on a numeric key; the number of cuts follows the key range."""
    cuts = max(1, -(-(high - low + 1) // rows_per_task))
    return {
        "url": url, "dbtable": table, "partitionColumn": key, "lowerBound": str(low), "upperBound": str(high),
        "numPartitions": str(cuts), "fetchsize": str(fetch_size),
    }


def read_table(spark: SparkSession, **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def write_table(df: DataFrame, url: str, table: str, batch: int = 10_000, mode: str = "overwrite") -> None:
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch), truncate="true").mode(mode).save()

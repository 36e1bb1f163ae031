"""Hourly totals over an event stream."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

HOUR = 3600


def hourly_counts(stream: DataFrame, ts: str, cancelled: Column, watermark: str = "1 hour") -> DataFrame:
    """Counts per hour window of kept and cancelled events; the state holds open hours only."""
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp"))
    return timed.withWatermark("_ts", watermark).groupBy(F.window("_ts", "1 hour").alias("w")).agg(
        F.count_if(~cancelled).alias("cnt"), F.count_if(cancelled).alias("cancelled_cnt")
    ).select(F.col("w.start").alias("from_ts"), F.col("w.end").alias("to_ts"), "cnt", "cancelled_cnt")


def _exists(spark, folder: str) -> bool:
    """Whether a stream has written anything there: without input no batch ran."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def _drive(stream: DataFrame, folder: str, checkpoint: str) -> None:
    """Run over all input that is there; each batch overwrites its own folder, so one replayed after a failure changes nothing."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    query = (stream.writeStream.outputMode("update").foreachBatch(write)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def _latest(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The newest row of each hour: a row that changed was written again under a larger batch number."""
    if not _exists(spark, folder):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(StructType([*schema.fields, StructField("batch", LongType())])).parquet(folder)
    rest = [f.name for f in schema if f.name not in ("from_ts", "to_ts")]
    return rows.groupBy("from_ts", "to_ts").agg(F.max_by(F.struct(*rest), "batch").alias("s")).select("from_ts", "to_ts", "s.*")


def run_to_folder(windows: DataFrame, folder: str, checkpoint: str) -> DataFrame:
    """Drive a windowed stream over all input that is there, and return the latest state of each window."""
    _drive(windows, folder, checkpoint)
    return _latest(windows.sparkSession, folder, windows.schema)


def _carry(key: tuple, frames: Iterator[pd.DataFrame], state, late: int) -> Iterator[pd.DataFrame]:
    """Running totals of the hours that changed and those after them.

    The state holds the totals of the closed hours, the time they reach to, and the open hours one by one.
    """
    reach, done, done_cancelled, open_hours = state.get if state.exists else (None, 0, 0, "[]")
    hours = {at: (cnt, cancelled) for at, cnt, cancelled in json.loads(open_hours)}
    rows = pd.concat(list(frames)).sort_values("batch")
    if reach is not None:
        rows = rows[rows["at"] >= reach]
    changed = rows["at"].min() if len(rows) else None
    hours.update((int(at), (int(cnt), int(cancelled))) for at, cnt, cancelled in zip(rows["at"], rows["cnt"], rows["cancelled_cnt"]))
    # The first stream takes no more events for hours that end this long before its newest hour.
    horizon = max(hours) - late if hours else None
    out, kept, cum, cum_cancelled = [], [], done, done_cancelled
    for at in sorted(hours):
        cnt, cancelled = hours[at]
        cum, cum_cancelled = cum + cnt, cum_cancelled + cancelled
        if changed is not None and at >= changed:
            out.append((at, cnt, cancelled, cum, cum_cancelled))
        if at + HOUR <= horizon:
            reach, done, done_cancelled = at + HOUR, cum, cum_cancelled
        else:
            kept.append((at, cnt, cancelled))
    state.update((reach, done, done_cancelled, json.dumps(kept)))
    yield pd.DataFrame(out, columns=["at", "cnt", "cancelled_cnt", "cum_cnt", "cum_cancelled_cnt"], dtype="int64")


def running_totals_to_folder(spark: SparkSession, hours: str, folder: str, checkpoint: str, late: int = HOUR) -> DataFrame:
    """Each hour with running totals, kept up by a second stream over what `run_to_folder` wrote to the folder `hours`.

    The totals live in Spark's state store and survive runs: a run reads the hours that are new or
    changed, one row each, and writes those and the open hours after them. `late` is the watermark of
    the first stream in seconds. Hours that it has closed are one pair of sums in the state; only open
    ones are held one by one. The input is one row per hour, so a single key carries the series.
    """
    schema = StructType.fromDDL("from_ts timestamp, to_ts timestamp, cnt long, cancelled_cnt long, cum_cnt long, cum_cancelled_cnt long")
    if not _exists(spark, hours):
        return spark.createDataFrame([], schema)
    changes = spark.readStream.schema("from_ts timestamp, to_ts timestamp, cnt long, cancelled_cnt long, batch long").parquet(hours)
    series = changes.select(F.lit(0).alias("series"), F.unix_seconds("from_ts").alias("at"), "cnt", "cancelled_cnt", "batch")
    totals = series.groupBy("series").applyInPandasWithState(
        lambda key, frames, state: _carry(key, frames, state, late),
        "at long, cnt long, cancelled_cnt long, cum_cnt long, cum_cancelled_cnt long",
        "reach long, done long, done_cancelled long, open_hours string", "update", GroupStateTimeout.NoTimeout)
    rows = totals.select(F.timestamp_seconds("at").alias("from_ts"), F.timestamp_seconds(F.col("at") + HOUR).alias("to_ts"),
                         "cnt", "cancelled_cnt", "cum_cnt", "cum_cancelled_cnt")
    _drive(rows, folder, checkpoint)
    return _latest(spark, folder, schema)

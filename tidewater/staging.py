"""Staging of intermediate results on shared storage, and sorted staging with carried state.

An unpartitioned ordered window (or one whose key holds most rows) runs in a single task. The
functions here give the same answers in parallel: rows are range-partitioned on the full order,
each slice is scanned on its own, and one small row per slice carries the state to the next.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tidewater.session import shared_dir

SLICE, POS = "_slice", "_pos"


def _written(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staged-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession) -> None:
    """Remove all staged tables of this application; call it when results have been read."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/staged-{spark.sparkContext.applicationId}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared folder and read it back, which cuts its lineage.

    A parquet table rather than a checkpoint: later steps read only the columns they need, filters
    with known thresholds skip row groups, and the join planner sees real sizes. The tables of one
    application lie in one folder; `discard` removes them once results have been read.
    """
    return _written(df)


def slices_for(df: DataFrame, partitions: int | None = None) -> int:
    return partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def stage_sorted(df: DataFrame, order: Sequence[Column], partitions: int | None = None) -> DataFrame:
    """Stage `df` range-partitioned and sorted on `order`, adding the slice number and the position in it.

    `order` should be total (end it with a unique key): then even a value that fills a third of
    the table is spread over many slices.
    """
    ident = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(slices_for(df, partitions), *order).sortWithinPartitions(*order)
    return _written(
        ranged.withColumn("_mid", ident)
        .withColumn(SLICE, F.shiftright("_mid", 33).cast("int"))
        .withColumn(POS, F.col("_mid").bitwiseAND((1 << 33) - 1))
        .drop("_mid")
    )


@dataclass(frozen=True)
class Scan:
    """One running value: `kind` is sum, max, min, last (latest non-null) or lag (previous row)."""

    kind: str
    value: Column


def _local(scan: Scan, w) -> Column:
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return {
        "sum": lambda: F.sum(scan.value).over(upto),
        "max": lambda: F.max(scan.value).over(upto),
        "min": lambda: F.min(scan.value).over(upto),
        "last": lambda: F.last(scan.value, ignorenulls=True).over(upto),
        "lag": lambda: F.lag(F.struct(scan.value.alias("v"))).over(w),
    }[scan.kind]()


def _slice_total(scan: Scan) -> Column:
    return {
        "sum": lambda: F.sum(scan.value),
        "max": lambda: F.max(scan.value),
        "min": lambda: F.min(scan.value),
        "last": lambda: F.max_by(scan.value, F.when(scan.value.isNotNull(), F.col(POS))),
        "lag": lambda: F.max_by(F.struct(scan.value.alias("v")), F.col(POS)),
    }[scan.kind]()


def _carry(scan: Scan, total: Column, w) -> Column:
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    return {
        "sum": lambda: F.sum(total).over(before),
        "max": lambda: F.max(total).over(before),
        "min": lambda: F.min(total).over(before),
        "last": lambda: F.last(total, ignorenulls=True).over(before),
        "lag": lambda: F.last(total).over(before),
    }[scan.kind]()


def _merge(scan: Scan, local: Column, carried: Column) -> Column:
    return {
        "sum": lambda: F.coalesce(local + carried, local, carried),
        "max": lambda: F.greatest(local, carried),
        "min": lambda: F.least(local, carried),
        "last": lambda: F.coalesce(local, carried),
        "lag": lambda: F.coalesce(local, carried)["v"],
    }[scan.kind]()


def scan_along(
    df: DataFrame,
    order_by: Sequence[Column],
    scans: Mapping[str, Scan],
    partition_by: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Running values along `order_by`, restarted per `partition_by`, without a one-task window.

    Only a key that continues over a slice border needs a carry, so the broadcast carry table has
    at most two rows per slice whatever the size of the data.
    """
    keys = list(partition_by)
    staged = stage_sorted(df, [F.col(k).asc() for k in keys] + list(order_by), partitions)
    totals = staged.groupBy(SLICE, *keys).agg(*[_slice_total(s).alias(f"_t_{o}") for o, s in scans.items()])
    along = Window.partitionBy(*keys).orderBy(SLICE) if keys else Window.orderBy(SLICE)
    if keys:
        edges = totals.groupBy(SLICE).agg(
            F.min(F.struct(*keys)).alias("_lo"), F.max(F.struct(*keys)).alias("_hi")
        )
        # A key other than the first or last of its slice lies wholly inside it.
        totals = (
            totals.join(F.broadcast(edges), SLICE)
            .filter(F.struct(*keys).eqNullSafe(F.col("_lo")) | F.struct(*keys).eqNullSafe(F.col("_hi")))
            .drop("_lo", "_hi")
        )
    carries = totals.select(
        F.col(SLICE).alias("_c_slice"),
        *[F.col(k).alias(f"_c_{k}") for k in keys],
        *[_carry(s, F.col(f"_t_{o}"), along).alias(f"_c_{o}") for o, s in scans.items()],
    )
    local_w = Window.partitionBy(SLICE, *keys).orderBy(POS)
    local = staged.select("*", *[_local(s, local_w).alias(f"_l_{o}") for o, s in scans.items()])
    on = F.col(SLICE) == F.col("_c_slice")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_c_{k}"))
    joined = local.join(F.broadcast(carries), on, "left")
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[_merge(s, F.col(f"_l_{o}"), F.col(f"_c_{o}")).alias(o) for o, s in scans.items()],
    )


def frames_along(
    df: DataFrame,
    order_by: Sequence[Column],
    frames: Mapping[str, Callable[[WindowSpec], Column]],
    before: int,
    after: int = 0,
    partition_by: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Columns over sliding frames that reach `before` rows back and `after` rows on, without a one-task window.

    Each function gets the ordered window (without a frame) and returns a column that looks no further than
    that. The rows are sorted into slices; every slice is joined by copies of the rows just before and after
    it, from as many slices as that takes, so its own rows see whole frames. At most before + after rows of each
    slice are copied. `order_by` should be total; frames start anew per `partition_by`.
    """
    keys = list(partition_by)
    staged = stage_sorted(df, [F.col(k).asc() for k in keys] + list(order_by), partitions)
    # One small row per slice that has rows: the rows before it, its size, and the slices that its edges can reach.
    sizes = [(r[SLICE], r["n"]) for r in staged.groupBy(SLICE).agg(F.count(F.lit(1)).alias("n")).orderBy(SLICE).collect()]
    starts = [0]
    for _, n in sizes:
        starts.append(starts[-1] + n)
    near = lambda places: [(sizes[j][0], starts[j], starts[j + 1]) for j in places]
    layout = [(slice_, starts[i], n, near(range(i + 1, min(i + 1 + before, len(sizes)))), near(range(max(0, i - after), i)))
              for i, (slice_, n) in enumerate(sizes)]
    spans = "array<struct<s: int, first: long, end: long>>"
    table = df.sparkSession.createDataFrame(layout, f"{SLICE} int, _start long, _n long, _next {spans}, _previous {spans}")
    placed = staged.join(F.broadcast(table), SLICE).withColumn("_row", F.col("_start") + F.col(POS))
    tail = placed.filter(F.col(POS) >= F.col("_n") - before).withColumn("_to", F.filter("_next", lambda x: x["first"] <= F.col("_row") + before))
    head = placed.filter(F.col(POS) < after).withColumn("_to", F.filter("_previous", lambda x: x["end"] > F.col("_row") - after))
    halos = [h for h, wanted in ((tail, before), (head, after)) if wanted]
    own = placed.select(*df.columns, SLICE, "_row", F.lit(True).alias("_own"))
    for halo in halos:
        own = own.union(halo.select(*df.columns, F.explode("_to.s").alias(SLICE), "_row", F.lit(False).alias("_own")))
    w = Window.partitionBy(SLICE, *keys).orderBy("_row")
    return own.select(*df.columns, *[f(w).alias(o) for o, f in frames.items()], "_own").filter("_own").drop("_own")

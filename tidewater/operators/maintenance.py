"""Table upkeep on plain files: upsert, delete, keys, constraint reports, rule-driven copies.

Parquet tables have no MERGE, UPDATE or DELETE, so each function returns the new version of the table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.windows import global_row_number


def upsert(base: DataFrame, new: DataFrame, key: str, update_cols: Sequence[str]) -> DataFrame:
    """Existing keys take `update_cols` from `new` and keep the rest; unknown keys are added.

    Of several new rows with one key the largest counts, compared column by column in the order of
    `base`, so a base row never becomes two. New rows without a key are all added.
    """
    rest = [c for c in new.columns if c != key]
    order = [c for c in base.columns if c in rest]
    keyed = new.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*[F.col(c) for c in order + [c for c in rest if c not in order]])).alias("_row"))
    new = keyed.select(key, "_row.*").select(*new.columns).unionByName(new.filter(F.col(key).isNull())) if rest else new.distinct()
    b, n = base.withColumn("_old", F.lit(True)).alias("b"), new.withColumn("_new", F.lit(True)).alias("n")
    both = b.join(n, F.col(f"b.{key}") == F.col(f"n.{key}"), "full")
    out = []
    for c in base.columns:
        if c == key:
            out.append(F.coalesce(f"b.{key}", f"n.{key}").alias(c))
        elif c in update_cols:
            out.append(F.when(F.col("n._new"), F.col(f"n.{c}")).otherwise(F.col(f"b.{c}")).alias(c))
        else:
            out.append(F.when(F.col("b._old"), F.col(f"b.{c}")).otherwise(F.col(f"n.{c}")).alias(c))
    return both.select(*out)


def delete_min(base: DataFrame, key: str) -> DataFrame:
    """All rows but those with the smallest key."""
    least = base.agg(F.min(key)).scalar()
    return base.filter(~F.coalesce(F.col(key) == least, F.lit(False)))


def next_row(spark: SparkSession, **values: Column) -> DataFrame:
    """One row built from scalar lookups, to append."""
    return spark.range(1).select(*[c.alias(n) for n, c in values.items()])


def assign_ids(base: DataFrame, new: DataFrame, key: str, order_by: Sequence[Column]) -> DataFrame:
    """Dense keys for the new rows, following the largest key of `base`."""
    top = F.coalesce(base.agg(F.max(key)).scalar(), F.lit(0))
    return global_row_number(new, order_by, "_rn").withColumn(key, top.cast("long") + F.col("_rn")).drop("_rn")


def constraint_report(
    df: DataFrame, not_null: Sequence[str] = (), unique: Sequence[Sequence[str]] = (),
    foreign: Mapping[str, tuple[DataFrame, str]] | None = None, max_length: Mapping[str, int] | None = None,
) -> DataFrame:
    """One row per rule with the number of violating rows (for keys: rows beyond the first)."""
    spark = df.sparkSession
    parts = []
    simple = [(f"not null {c}", F.count_if(F.col(c).isNull())) for c in not_null]
    simple += [(f"length {c}", F.count_if(F.length(c) > n)) for c, n in (max_length or {}).items()]
    if simple:
        row = df.agg(F.array(*[F.struct(F.lit(n).alias("rule"), c.alias("violations")) for n, c in simple]).alias("s"))
        parts.append(row.select(F.explode("s").alias("s")).select("s.*"))
    for cols in unique:
        known = df.filter(" AND ".join(f"`{c}` IS NOT NULL" for c in cols))
        per = known.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
        parts.append(per.agg(F.lit(f"unique {','.join(cols)}").alias("rule"),
                             F.coalesce(F.sum(F.col("_c") - 1), F.lit(0).cast("long")).alias("violations")))
    for c, (parent, pk) in (foreign or {}).items():
        orphans = df.filter(F.col(c).isNotNull()).join(parent.select(F.col(pk).alias("_pk")), F.col(c) == F.col("_pk"), "left_anti")
        parts.append(orphans.agg(F.lit(f"foreign {c}").alias("rule"), F.count(F.lit(1)).alias("violations")))
    out = parts[0] if parts else spark.createDataFrame([], "rule string, violations long")
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def create_if_missing(spark: SparkSession, table: str, schema, location: str | None = None) -> None:
    """An empty table, unless there is one of this name; `location` as in `load_table`."""
    if not spark.catalog.tableExists(table):
        spark.createDataFrame([], schema).write.options(**({"path": location} if location else {})).saveAsTable(table)


def snapshot(df: DataFrame, table: str) -> None:
    """Create-table-as copy."""
    df.write.mode("overwrite").saveAsTable(table)


def apply_rules(spark: SparkSession, matched: DataFrame, source, target) -> list[tuple[str, str]]:
    """Carry out 'Copy with data', 'Copy schema' or 'Skip' for each named data set.

    `source(name)` and `target(name)` give paths. The names come to the driver one part after the
    other; every copy is a Spark job. Names without a rule are skipped.
    """
    done = []
    for row in matched.select("name", "action").toLocalIterator():
        action = row["action"] or "Skip"
        if action != "Skip":
            data = spark.read.parquet(source(row["name"]))
            (data if action == "Copy with data" else data.limit(0)).write.mode("overwrite").parquet(target(row["name"]))
        done.append((row["name"], action))
    return done

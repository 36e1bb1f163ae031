"""Readers and writers of files."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.text import decimal_comma


@contextlib.contextmanager
def java_charsets(spark: SparkSession) -> Iterator[None]:
    """Lets writers use any charset inside the block; the session's setting comes back afterwards."""
    key = "spark.sql.legacy.javaCharsets"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _struct(schema: str | T.StructType) -> T.StructType:
    return T._parse_datatype_string(schema) if isinstance(schema, str) else schema


def read_delimited(spark: SparkSession, path: str, schema, sep: str = ",", header: bool = True,
                   decimal: str = ".", encoding: str = "UTF-8") -> DataFrame:
    """Delimited text with a given schema; NaN becomes NULL.

    With `decimal=','` fractional columns are read as text and converted, unreadable cells to NULL.
    One-byte code pages (cp1251, cp437) are read byte by byte and mapped to their characters, so no
    session setting is touched.
    """
    wanted = _struct(schema)
    numbers = [f.name for f in wanted if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    raw = T.StructType([
        T.StructField(f.name, T.StringType() if decimal == "," and f.name in numbers else f.dataType) for f in wanted])
    mapped = encoding.upper() not in ("UTF-8", "US-ASCII", "ISO-8859-1", "UTF-16", "UTF-16BE", "UTF-16LE", "UTF-32")
    df = spark.read.schema(raw).csv(path, sep=sep, header=header, quote='"', encoding="ISO-8859-1" if mapped else encoding)
    if mapped:
        old = bytes(range(128, 256))
        new = "".join(old[i : i + 1].decode(encoding, "replace") for i in range(128))
        df = df.select(*[
            (F.translate(f"`{f.name}`", old.decode("latin-1"), new) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")).alias(f.name) for f in raw])
    exprs = []
    for f in wanted:
        c = F.col(f"`{f.name}`")
        if decimal == "," and f.name in numbers:
            c = decimal_comma(c)
        exprs.append(F.nanvl(c, F.lit(None)).alias(f.name) if f.name in numbers else c.alias(f.name))
    return df.select(*exprs)


def read_headerless(spark: SparkSession, path: str, schema, sep: str = ",") -> DataFrame:
    """Delimited text without a header line; the schema names the columns."""
    return read_delimited(spark, path, schema, sep, header=False)


def read_json(spark: SparkSession, path: str, schema, multi_line: bool = True) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=multi_line)


def pick_from_array(df: DataFrame, array: str, index: int, field: str, out: str) -> DataFrame:
    """Field of the element at `index` (zero-based) of an array of structs, NULL outside it."""
    return df.select("*", F.get(array, F.lit(index))[field].alias(out))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def write_lines(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").text(path)


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").csv(path, header=True, sep=sep)


def load_table(spark: SparkSession, path: str, schema, table: str, location: str | None = None) -> DataFrame:
    """Typed bulk load of a CSV with header, replacing the table. Empty cells become NULL.

    `location` is the table's folder; without it the table lies in the session's warehouse.
    """
    df = spark.read.schema(schema).csv(path, header=True, quote='"')
    df.write.mode("overwrite").options(**({"path": location} if location else {})).saveAsTable(table)
    return spark.table(table)


def land_month(spark: SparkSession, src: str, month: str, schema, landing: str) -> str:
    """Copy one month's file to the landing area, replacing only that month.

    `src` holds a `{month}` place. The month is a partition folder, so readers prune to it.
    """
    df = spark.read.schema(schema).csv(src.format(month=month), header=True, quote='"')
    target = f"{landing.rstrip('/')}/month={month}"
    df.write.mode("overwrite").parquet(target)
    return target


def load_month(spark: SparkSession, landing: str, month: str) -> DataFrame:
    return spark.read.parquet(landing).filter(F.col("month").cast("string") == month)


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema) -> DataFrame:
    """Hand-written rows with explicit types."""
    return spark.createDataFrame(list(rows), schema)

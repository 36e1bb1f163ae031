"""A flat-advertisement table derived from sold lines, shared by the repair and price queries.

The column rules are plain SQL that Spark and the checking engine both read, so that both start
from the same rows. Missing values follow fixed rules, because the source tables have none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.tables import Tables

COLUMNS = {
    "line_key": "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)",
    "last_price": "l_extendedprice",
    "total_area": "CAST(l_quantity + p_size AS DOUBLE)",
    "first_day": "l_shipdate",
    "rooms": "CAST(l_linenumber - 1 AS DOUBLE)",
    "ceiling_height": "CASE WHEN l_discount = 0 THEN NULL WHEN l_suppkey % 17 = 0 THEN 27.0 WHEN l_suppkey % 19 = 0 THEN 14.0 WHEN l_suppkey % 23 = 0 THEN 265.0 ELSE 2.5 + l_tax * 10 END",
    "floors_total": "CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE CAST(p_size % 25 + 1 AS DOUBLE) END",
    "floor": "CASE WHEN l_orderkey % 29 = 0 THEN NULL ELSE CAST(l_suppkey % (p_size % 25 + 1) + 1 AS DOUBLE) END",
    "living_area": "CASE WHEN l_linenumber = 3 THEN NULL ELSE (l_quantity + p_size) * 0.5 END",
    "kitchen_area": "CASE WHEN l_discount = 0.05 THEN NULL ELSE (l_quantity + p_size) * (0.125 + l_tax) END",
    "is_apartment": "CASE WHEN l_tax = 0 THEN NULL ELSE l_tax = 0.08 END",
    "balcony": "CASE WHEN l_linenumber > 4 THEN NULL ELSE CAST(l_suppkey % 4 AS DOUBLE) END",
    "locality_name": "CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_partkey % 3 = 0 THEN concat('посёлок городского типа ', p_brand) WHEN l_partkey % 3 = 1 THEN concat('посёлок ', p_brand) ELSE p_brand END",
    "center_distance": "CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE CAST((l_suppkey * 137 + l_orderkey) % 30000 AS DOUBLE) END",
    "parks_around": "CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE CAST(l_linenumber % 3 AS DOUBLE) END",
    "park_distance": "CASE WHEN l_suppkey % 10 = 0 OR l_linenumber % 3 = 0 OR l_orderkey % 31 = 0 THEN NULL ELSE CAST(l_partkey % 2500 AS DOUBLE) END",
    "days_on_sale": "CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_orderkey % 700 AS DOUBLE) END",
    "images": "CAST(l_quantity % 21 AS DOUBLE)",
}

SQL = "flats AS (SELECT " + ", ".join(f"{rule} AS {name}" for name, rule in COLUMNS.items()) + \
    " FROM lineitem JOIN part ON p_partkey = l_partkey)"


def flats(t: Tables, *columns: str) -> DataFrame:
    """The derived table, or only the named columns of it."""
    names = columns or tuple(COLUMNS)
    both = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    return both.selectExpr(*[f"{COLUMNS[n]} AS {n}" for n in names])

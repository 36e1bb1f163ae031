"""Compare registered queries with their SQL in DuckDB.

Usage: python tests/check_oracle.py [folder] [name part ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from tidewater import registry  # noqa: E402
from tidewater.session import get_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _key(value):
    return (value is None, str(type(value)), str(value))


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(r[i] for i in order) for r in rows]
    return sorted(out, key=lambda r: [_key(round(v, 3) if isinstance(v, float) else v) for v in r])


def same(a, b, exact: bool) -> bool:
    if isinstance(a, float) and isinstance(b, (int, float)) and not exact:
        return math.isclose(a, b, rel_tol=1e-6, abs_tol=1e-6)
    return type(a) is type(b) and a == b or (a is None and b is None)


def compare(spark, con, folder: str, name: str, exact: bool = True) -> str:
    """'' when equal, else what differs."""
    df = registry.queries()[name](spark, folder)
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    sql = registry.oracle_sql().get(name)
    if sql is None:
        return "" if got else "no rows"
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(got_cols) != sorted(want_cols):
        return f"columns {sorted(got_cols)} / {sorted(want_cols)}"
    if len(got) != len(want):
        return f"{len(got)} rows / {len(want)} rows"
    if not want:
        return "both empty"
    bad = [(g, w) for g, w in zip(rows_of(got_cols, got), rows_of(want_cols, want))
           if not all(same(x, y, exact) for x, y in zip(g, w))]
    return f"{len(bad)} of {len(got)} rows differ: {bad[0]}" if bad else ""


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = get_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    failed = 0
    for name in registry.queries():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            verdict = compare(spark, con, folder, name)
        except Exception as error:  # noqa: BLE001
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(verdict)
        mark = "FAIL" if verdict else ("ok" if name in registry.oracle_sql() else "rows")
        print(f"{mark:4} {name} {time.time() - start:.1f}s {verdict}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())

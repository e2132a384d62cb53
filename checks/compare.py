"""Run queries and their SQL side by side: python -m checks.compare [folder] [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

from checks.oracles import all_oracles
from checks.queries import all_queries
from pulsetide.session import build_session


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(value):
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def sorted_rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def difference(con: duckdb.DuckDBPyConnection, name: str, result: DataFrame) -> str | None:
    """What sets a query's rows apart from its SQL's, or None."""
    got = sorted_rows(result.columns, [tuple(r) for r in result.collect()])
    cursor = con.execute(all_oracles()[name])
    names = [d[0] for d in cursor.description]
    expected = sorted_rows(names, cursor.fetchall())
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} != {sorted(names)}"
    if got == expected:
        return None
    wrong = [p for p in zip(got, expected) if p[0] != p[1]][:2]
    return f"{len(got)} rows, expected {len(expected)}; first differences {wrong}"


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(all_queries())
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            note = difference(con, name, all_queries()[name](spark, folder))
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            note = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += note is not None
        print("FAIL" if note else "ok  ", name, note or f"{time.time() - start:.1f}s", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
